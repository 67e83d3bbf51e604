"""Streaming forms equal their batch forms."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
import __spark_entry__ as E


def test_bells_stream_equals_batch(spark):
    q = E.queries()
    a = q["pressure_bells"](spark, SF_SMALL)
    b = q["pressure_bells_stream"](spark, SF_SMALL)
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and b.count() == a.count()


def test_latch_stream_equals_batch(spark):
    q = E.queries()
    a = q["bell_latch"](spark, SF_SMALL)
    b = q["bell_latch_stream"](spark, SF_SMALL).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.count() == a.count()


def test_latch_holds_bells_across_batches(spark, tmp_path):
    """A bell of one micro-batch is consumed by a stop of a later one, however
    much later, and equals the batch form."""
    import datetime as dt

    from threadlake.streaming import pressure as PR
    from threadlake.streaming.runner import run_available
    schema = ("event_id long, session_id string, ts timestamp_ntz, type string, model string, input_tokens long, "
              "cache_read_input_tokens long, cache_creation_input_tokens long, is_stop boolean")
    t0 = dt.datetime(2024, 1, 1)
    row = lambda i, s, days, kind, tokens, stop: (i, s, t0 + dt.timedelta(days=days), kind, "m", tokens, None, None, stop)
    parts = [[row(1, "1", 0, "message_start", 180, False), row(2, "2", 0, "message_start", 150, False)],
             [row(3, "1", 0.1, "message_start", 145, False), row(4, "2", 9, "other", 0, True)],
             [row(5, "1", 30, "other", 0, True), row(6, "1", 31, "other", 0, True)]]
    src = str(tmp_path / "events")
    for p in parts:
        spark.createDataFrame(p, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = run_available(PR.latch_stream(stream, (), 200), "latch-batches", spark)
    every = spark.read.schema(schema).parquet(src)
    want = PR.latch(PR.bells(every, (), 200), every.filter("is_stop"))
    key = lambda df: sorted(map(str, df.withColumn("token_count", F.col("token_count").cast("double"))
                                .select(*sorted(want.columns)).collect()))
    assert key(got) == key(want)
    assert [r["label"] for r in got.orderBy("stop_event_id").collect()] == ["bell_70", "bell_85", "periodic"]


def test_out_of_order_across_batches_equals_batch(spark, tmp_path):
    """Events that come in the wrong order, in and across micro-batches, give the
    batch answer once the watermark has passed them."""
    import datetime as dt
    import random

    from threadlake.streaming import pressure as PR
    from threadlake.streaming.runner import run_available
    schema = ("event_id long, session_id string, ts timestamp_ntz, type string, model string, input_tokens long, "
              "cache_read_input_tokens long, cache_creation_input_tokens long, is_stop boolean")
    rng, t0 = random.Random(6), dt.datetime(2024, 1, 1)
    rows = []
    for i in range(240):
        stop = rng.random() < 0.25
        rows.append((i, f"s{rng.randrange(4)}", t0 + dt.timedelta(seconds=i * 2, microseconds=rng.randrange(1000)),
                     "other" if stop else "message_start", "m", 0 if stop else rng.choice([100, 145, 172, 195]), None, None, stop))
    # each event comes up to 40 places late; the last batch moves the watermark on
    shuffled = [r for _, r in sorted(((i + rng.randrange(40), r) for i, r in enumerate(rows)), key=lambda x: x[0])]
    end = (1000, "end", t0 + dt.timedelta(days=1), "message_start", "m", 1, None, None, False)
    parts = [shuffled[i:i + 60] for i in range(0, 240, 60)] + [[(*end[:7], None, True)]]
    src = str(tmp_path / "events")
    for p in parts:
        spark.createDataFrame(p, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    old = spark.conf.get(PR.ROCKSDB[0])
    spark.conf.set(*PR.ROCKSDB)
    try:
        got = run_available(PR.latch_stream_ordered(stream, "2 minutes", (), 200), "latch-ordered", spark)
    finally:
        spark.conf.set(PR.ROCKSDB[0], old)
    every = spark.createDataFrame(rows, schema)
    want = PR.latch(PR.bells(every, (), 200), every.filter("is_stop"))
    key = lambda df: sorted(map(str, df.withColumn("token_count", F.col("token_count").cast("double"))
                                .select(*sorted(want.columns)).collect()))
    assert key(got) == key(want) and got.count() > 30
