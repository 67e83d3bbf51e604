"""Distributed global row numbering (no single-partition window)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlake.session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def with_global_index(df: DataFrame, order_cols: list[str], name: str = "row_idx",
                      num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based dense row number following ``order_cols`` (must be a total
    order).

    Range-partition + sort, number rows inside each partition, then add the
    prefix sum of earlier partitions' counts.  Range bounds are sampled anew at
    every evaluation, so the partitioned rows are checkpointed once and every
    use reads them.  The offsets table has one row per partition, so
    broadcasting it is size-bounded; no task sees more than its own partition.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = (ranged.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
              .withColumn("_local", F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1)))
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.col("_local"))
            .drop("_mid", "_pid", "_local", "_off"))


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash-partition by ``keys`` when the input has fewer partitions than the
    cluster has cores (e.g. one large row group), so CPU-heavy per-row work
    runs in parallel.  Later aggregations grouped by a superset of ``keys``
    reuse this partitioning (no second exchange).  Well-partitioned input is
    left alone."""
    want = df.sparkSession.sparkContext.defaultParallelism
    try:
        n = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - streaming or unplannable input
        return df
    return df.repartition(want, *keys) if n < want else df


def number_in_files(df: DataFrame, file_col: str, block_col: str, order_col: str,
                    name: str = "line_no") -> DataFrame:
    """0-based position of each row within its file, in read order.

    Rows are numbered inside their split (file, block start) — a split is at
    most ``spark.sql.files.maxPartitionBytes`` of one file, so no group is
    unbounded even for a huge file — and each split is offset by the row counts
    of the earlier splits of the same file (a table of one row per split)."""
    from pyspark.sql import Window

    w = Window.partitionBy(file_col, block_col).orderBy(order_col)
    local = df.withColumn("_rn", F.row_number().over(w) - 1)
    counts = local.groupBy(file_col, block_col).agg(F.count(F.lit(1)).alias("_c"))
    ws = Window.partitionBy(file_col).orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(file_col, block_col, F.coalesce(F.sum("_c").over(ws), F.lit(0)).alias("_off"))
    return (local.join(offs, [file_col, block_col])
            .withColumn(name, (F.col("_off") + F.col("_rn")).cast("int")).drop("_rn", "_off"))
