"""Shared pieces of the training-data operators.

* ``table``       one of the given tables;
* ``stored``      write an intermediate table to the shared folder named by
  ``spark.checkpoint.dir`` and read it back: cuts the lineage, survives lost
  executors and makes non-deterministic steps (range sampling) happen once;
* ``running``     exact global or per-group prefix sums and row numbers without
  a group ever sitting in one task.

Words are maximal runs of characters other than U+0020 and U+0009..U+000D
everywhere (``WORD``); in Python that is ``bytes.split()`` on UTF-8.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadlake.session import scratch_path, ship_package

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Columns of ``documents``; pipeline stages return exactly these.
DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark drops an execution's shuffle files when it ends, not at some later GC.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder, read back.  The
    shuffle files behind it go when it is written; the written table is what
    later steps read, also after a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(table: DataFrame) -> None:
    """Delete a table made by ``stored`` that nothing reads any more."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ready(spark: SparkSession) -> None:
    """Make the package importable in Python workers of this application."""
    ship_package(spark)


def n_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def fingerprint(text: Column) -> tuple[Column, Column]:
    """128 bits of a text (two seeds), null included: with doc_id, what tells
    rows apart."""
    return F.xxhash64(text), F.xxhash64(F.lit("second"), text)


def packed(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """The whole rows as one struct ``doc`` beside helper columns, so that no
    column of docs, whatever its name, meets a helper; ``select("doc.*")`` is
    the way back."""
    return docs.select(F.struct("*").alias("doc"), *columns)


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def running(df: DataFrame, order: list[str], value: str, group: list[str] | None = None,
            name: str = "running") -> DataFrame:
    """``df`` plus ``before`` (sum of ``value`` over the rows that come earlier
    in ``order``, inside ``group`` when given) and ``rank`` (how many come
    earlier).  ``order`` must be a total order up to rows that are equal in it.

    The rows are range-partitioned by (group, order) and written once together
    with their partition number; sums run inside each partition and are shifted
    by the totals of earlier partitions.  A group that holds a third of all
    rows therefore spans many partitions.  The totals have one row per
    (partition, group that begins or ends there), the only thing broadcast.
    """
    group = group or []
    ranged = (df.repartitionByRange(n_partitions(df), *group, *order)
              .withColumn("_pid", F.spark_partition_id()))
    rows = stored(ranged, name)
    inside = Window.partitionBy("_pid", *group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    totals = rows.groupBy(*group, "_pid").agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    earlier = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    shift = totals.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_pid").alias("_p"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum0"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows0"))
    same = F.col("_pid") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (rows.withColumn("before", F.sum(value).over(inside) - F.col(value))
            .withColumn("rank", F.row_number().over(inside) - 1)
            .join(shift, same)
            .withColumn("before", F.col("before") + F.col("_sum0"))
            .withColumn("rank", F.col("rank") + F.col("_rows0"))
            .drop("_pid", "_p", "_sum0", "_rows0", *[f"_g{i}" for i in range(len(group))]))
