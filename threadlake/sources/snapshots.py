"""Snapshot sinks (S11): immutable ``<base>/<table>/snapshot=<id>/`` parquet
directories and numbered pointers ``<base>/_pointer/set=<n>/`` that name one
snapshot of every table published so far.

A set of tables is published together: all are written first, then one new
pointer is written; nothing is ever overwritten.  A pointer counts once Spark
has marked it complete, so a failed job leaves the previous set readable, and
its left-overs never get in the way of the next one, which takes a new id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_POINTER = "table string, snapshot long, path string"


def _sets(spark: SparkSession, base: str) -> DataFrame | None:
    """Rows of every complete pointer, or None when there is none yet.  Only
    "no such path" means that; any other storage error is raised."""
    path = f"{base.rstrip('/')}/_pointer"
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        return None
    whole = [f"{s.getPath()}" for s in fs.listStatus(fs_path)
             if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    if not whole:
        return None
    rows = spark.read.schema(_POINTER).option("basePath", path).parquet(*whole)
    return rows.withColumn("set", F.regexp_extract(F.col("_metadata.file_path"), r"/set=(\d+)/", 1).cast("long"))


def publish(tables: dict[str, DataFrame], base: str, snapshot_id: int | None = None) -> int:
    """Write the tables as one new snapshot and point at them; returns its id
    (``snapshot_id``, or one more than the highest so far)."""
    spark = next(iter(tables.values())).sparkSession
    base = base.rstrip("/")
    old = _sets(spark, base)
    current: dict[str, tuple[int, str]] = {}
    number = -1
    if old is not None:
        number = old.agg(F.max("set")).first()[0]
        current = {r["table"]: (r["snapshot"], r["path"]) for r in old.filter(F.col("set") == number).collect()}
    sid = snapshot_id if snapshot_id is not None else 1 + max([-1, *(s for s, _ in current.values())])
    for name, df in tables.items():
        path = f"{base}/{name}/snapshot={sid}-{number + 1}"
        # a half-written try of the same set was never pointed at
        df.write.mode("overwrite").parquet(path)
        current[name] = (sid, path)
    pointer = spark.createDataFrame([(n, s, p) for n, (s, p) in current.items()], _POINTER)
    pointer.coalesce(1).write.mode("overwrite").parquet(f"{base}/_pointer/set={number + 1}")
    return sid


def _current(spark: SparkSession, base: str, table: str):
    sets = _sets(spark, base)
    if sets is None:
        return None
    return sets.filter(F.col("table") == table).orderBy(F.desc("set")).first()


def latest_snapshot(spark: SparkSession, base: str, table: str) -> int | None:
    row = _current(spark, base, table)
    return None if row is None else int(row["snapshot"])


def read_latest(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    row = _current(spark, base, table)
    return None if row is None else spark.read.parquet(row["path"])


def bucketed(turns: DataFrame, rows_per_file: int | None = None) -> DataFrame:
    """Turns dealt by range of (session, turn): files hold whole key ranges, so
    min/max statistics prune, one huge session spans several files, and the
    number of write tasks follows the shuffle partitions, not a constant."""
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")) if rows_per_file is None else max(
        1, -(-turns.count() // rows_per_file))
    return turns.repartitionByRange(n, "session_id", "turn_idx").sortWithinPartitions("session_id", "turn_idx")


def ordered_edges(edges: DataFrame) -> DataFrame:
    """Edges dealt by range of (type, source): one type spans many files."""
    n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["edge_type", "src_session_id", "src_turn_idx"]
    return edges.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
