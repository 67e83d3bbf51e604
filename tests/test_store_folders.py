"""Many small buckets: folders that they share, and pointers without Spark jobs."""
import glob

from pyspark.sql import functions as F

from threadlake.sources import store


def _days(spark, lo, hi, text):
    s = spark.range(lo, hi).select(F.col("id").cast("string").alias("session_id"), F.date_format(
        F.timestamp_add("DAY", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz")), "yyyy-MM-dd").alias("started_at"), F.lit(text).alias("text"))
    return {"sessions": s.withColumn("bucket", store.session_bucket(F.col("started_at"), F.col("session_id")))}


def test_buckets_share_folders(spark, tmp_path):
    """200 buckets are a few folders; a bucket that another set took over does not
    count where it was before, and worn folders are written anew."""
    base, none = str(tmp_path), spark.createDataFrame([], "session_id string")
    order = {"sessions": ["session_id"]}
    folders = lambda: {b.path for b in store.pointer(spark, base)[1]}
    texts = lambda: dict(store.read(spark, base, "sessions").groupBy("text").count().collect())
    store.upsert(spark, base, "session_id", _days(spark, 0, 200, "a"), none, order)
    assert len(folders()) == len(glob.glob(f"{base}/sessions/set=*/bucket=*")) == 7 and texts() == {"a": 200}
    first = folders()
    _, touched = store.upsert(spark, base, "session_id", _days(spark, 5, 15, "b"), none, order)
    assert len(touched) == 10 and texts() == {"a": 190, "b": 10} and len(folders()) == 8
    assert store.read(spark, base, "sessions", touched).count() == 10
    _, touched = store.upsert(spark, base, "session_id", _days(spark, 3, 30, "c"), none, order)
    assert len(touched) == 27 and texts() == {"a": 173, "c": 27}
    assert len(first - folders()) == 1  # five of its 32 were left
    gone = spark.createDataFrame([("199",), ("7",)], "session_id string")
    store.upsert(spark, base, "session_id", {"sessions": _days(spark, 0, 0, "")["sessions"]}, gone, order)
    assert texts() == {"a": 172, "c": 26}


def test_pointers_need_no_spark_job(spark, tmp_path):
    """And those of older stores, Parquet files, are still read."""
    base, none = str(tmp_path), spark.createDataFrame([], "session_id string")
    store.upsert(spark, base, "session_id", _days(spark, 0, 3, "a"), none, {})
    spark.sparkContext.setJobGroup("pointers", "")
    number, entries = store.pointer(spark, base)
    assert len(entries) == 3 and store.retire(spark, base) == []
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("pointers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    old = spark.createDataFrame([("sessions", "x.0", f"{base}/old/bucket=x.0", entries[0].schema)], store.POINTER)
    _days(spark, 7, 9, "old")["sessions"].drop("bucket").write.parquet(f"{base}/old/bucket=x.0")
    old.coalesce(1).write.parquet(f"{base}/_pointer/set={number + 1}")
    assert [tuple(r) for r in store.read(spark, base, "sessions").select("text", "bucket").distinct().collect()] == [("old", "x.0")]
