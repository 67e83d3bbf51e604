"""Bucketed copy-on-write store (S5, S11, ST5).

A table is a set of *buckets*; a bucket's rows are in one immutable folder of
Parquet files::

    <base>/<table>/set=<n>-<try>/bucket=<b>/part-*.parquet
    <base>/_pointer/set=<n>/pointer.json        schema of every table, and its folders

A pointer names one folder for every bucket of every table.  Publishing writes
the touched buckets and one new pointer; all other buckets are carried over by
their name, so what a batch writes follows the buckets it touches, not the
store.  ``upsert`` puts up to ``PACK`` neighbouring buckets into one folder (named
after the first, their rows carry the bucket in ``_bucket``; ``held`` of them were
written; the pointer lists those that are still there): files and folders cost more than rows, and there are four buckets a day.
When another set has taken over some of them, readers leave their rows out; when
most are gone, the next upsert writes the rest anew.  A pointer counts once its ``_SUCCESS`` file is there: a failed job
leaves the last set readable, and a repeated one writes to folders of its own.
Readers list the names in ``_pointer`` and read the newest one alone.

Sessions are bucketed by the day they began and a hash (``session_bucket``):
transcripts grow while they are new, so a batch meets few buckets, and a heavy
day is spread.  Inside a file rows are sorted; a folder of much volume is cut by
adaptive execution, so one huge session spans tasks and files.

``retire`` drops old pointers and the folders that only they name.  One writer at
a time is assumed; readers of a retired set fail.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.session import settings

POINTER = "table string, bucket string, path string, schema string"  # of older stores, as Parquet
#: Buckets in a folder that ``upsert`` writes at most; a folder of ``WORN`` or more of which
#: less than a quarter is left is written anew.
PACK, WORN = 32, 8
#: Folders are listed by this many tasks at most (Spark: one for each of 10,000).
LISTING = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": "64"}
#: Hash buckets of a day.
SPLITS = 4
#: Tasks put their files in place themselves: a folder counts once a pointer names it.
BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
#: Pointers that stay readable.
KEEP = 3


def session_bucket(started_at: Column, session_id: Column, splits: int = SPLITS) -> Column:
    """Day of the beginning (``none`` without one) and a hash of the session."""
    day = F.regexp_extract(F.coalesce(started_at, F.lit("")), r"^\d{4}-\d{2}-\d{2}", 0)
    return F.concat(F.when(day == "", F.lit("none")).otherwise(day), F.lit("."),
                    F.pmod(F.xxhash64(session_id), F.lit(splits)).cast("string"))


# --- files -----------------------------------------------------------------------------------

def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _fs(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the pointers, whole or not, newest first: names only."""
    where = f"{base}/_pointer"
    fs = _fs(spark, where)
    if not fs.exists(_path(spark, where)):
        return []
    found = (re.fullmatch(r"set=(\d+)", s.getPath().getName()) for s in fs.listStatus(_path(spark, where)))
    return sorted((int(m[1]) for m in found if m), reverse=True)


def _whole(spark: SparkSession, base: str, number: int) -> bool:
    name = f"{base}/_pointer/set={number}/_SUCCESS"
    return _fs(spark, name).exists(_path(spark, name))


@dataclass(frozen=True)
class Bucket:
    table: str
    bucket: str
    path: str
    schema: str
    held: int | None = None  # buckets of a shared folder


def _entries(spark: SparkSession, base: str, number: int) -> list[Bucket]:
    """What a pointer names."""
    where = f"{base}/_pointer/set={number}"
    fs, name = _fs(spark, where), _path(spark, f"{where}/pointer.json")
    if not fs.exists(name):
        return [Bucket(**r.asDict()) for r in spark.read.schema(POINTER).parquet(where).collect()]
    stream = fs.open(name)
    try:
        said = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return [Bucket(x["table"], b, x["path"], said["schemas"][x["schema"]], x["held"])
            for x in said["folders"] for b in x["buckets"]]


def _write_pointer(spark: SparkSession, base: str, number: int, entries: list[Bucket]) -> None:
    folders: dict[tuple, list[str]] = {}
    schemas: dict[str, int] = {}
    for b in entries:
        at = schemas.setdefault(b.schema, len(schemas))
        folders.setdefault((b.table, b.path, at, b.held), []).append(b.bucket)
    said = {"schemas": [*schemas], "folders": [{"table": t, "path": path, "schema": at, "held": held, "buckets": some}
                                               for (t, path, at, held), some in folders.items()]}
    where = f"{base}/_pointer/set={number}"
    fs = _fs(spark, where)
    for name, text in (("pointer.json", json.dumps(said)), ("_SUCCESS", "")):
        out = fs.create(_path(spark, f"{where}/{name}"), False)  # never over another one
        out.write(bytearray(text, "utf-8"))
        out.close()


def pointer(spark: SparkSession, base: str) -> tuple[int, list[Bucket]] | None:
    """The newest whole pointer: its number and one entry per bucket."""
    base = base.rstrip("/")
    for n in _numbers(spark, base):
        if _whole(spark, base, n):
            return n, _entries(spark, base, n)
    return None


# --- reading ---------------------------------------------------------------------------------

def read(spark: SparkSession, base: str, table: str, buckets: set[str] | None = None) -> DataFrame | None:
    """A table of the newest set (with its ``bucket`` column), or None if it was
    never published.  ``buckets`` leaves the folders of all others out."""
    now = pointer(spark, base)
    mine = [b for b in now[1] if b.table == table] if now else []
    return _frame(spark, mine, buckets) if mine else None


def _frame(spark: SparkSession, entries: list[Bucket], buckets: set[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(entries[0].schema))
    live = [b for b in entries if b.path and (buckets is None or b.bucket in buckets)]
    if not live:
        return spark.createDataFrame([], schema)
    named = Counter(b.path for b in live)
    own = [b.path for b in live if b.held is None]
    whole = sorted({b.path for b in live if b.held is not None and b.held == named[b.path]})
    part = [b for b in live if b.held is not None and b.held != named[b.path]]
    plain = T.StructType([f for f in schema if f.name != "bucket"])
    packed = T.StructType([*plain, T.StructField("_bucket", T.StringType())])

    def files(kind: T.StructType, paths: list[str]) -> DataFrame:
        with settings(spark, LISTING):
            return spark.read.schema(kind).parquet(*paths)

    frames = []
    if own:
        name = F.regexp_extract(F.col("_metadata.file_path"), r"/bucket=([^/]+)/", 1)
        frames.append(files(plain, own).select("*", name.alias("bucket")))
    if whole:
        frames.append(files(packed, whole).withColumnRenamed("_bucket", "bucket"))
    if part:  # a bucket counts in the folder that the pointer names for it
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(set=[^/]+/bucket=[^/]+)/", 1)
        there = spark.createDataFrame([("/".join(b.path.split("/")[-2:]), b.bucket) for b in part], "_folder string, _b string")
        rows = files(packed, sorted({b.path for b in part})).select("*", folder.alias("_folder"))
        frames.append(rows.join(F.broadcast(there), (rows["_folder"] == there["_folder"]) & (rows["_bucket"] == there["_b"]),
                                "left_semi").drop("_folder").withColumnRenamed("_bucket", "bucket"))
    return reduce(DataFrame.union, (f.select(schema.names) for f in frames))


# --- writing ---------------------------------------------------------------------------------

def publish(spark: SparkSession, base: str, tables: dict[str, DataFrame], order: dict[str, list[str]],
            touched: set[str] | None = None, now: tuple[int, list[Bucket]] | None = None,
            packs: dict[str, str] | None = None) -> int:
    """Write ``tables`` (each with a ``bucket`` column) as a new set, those with
    an ``order`` sorted by it and dealt by its ranges.  With
    ``touched`` they replace these buckets alone, else their whole tables.
    ``packs`` names for each bucket the one whose folder it shares.
    Returns the number of the set.  ``now`` is the newest pointer, if it is known."""
    base = base.rstrip("/")
    now = now or pointer(spark, base)
    number = 1 + max(_numbers(spark, base), default=-1)
    entries = [b for b in (now[1] if now else [])
               if b.table not in tables or (touched is not None and b.path and b.bucket not in touched)]

    def write(name: str, df: DataFrame) -> list[Bucket]:
        path = f"{base}/{name}/set={number}-{uuid.uuid4().hex[:8]}"
        schema, keys = df.schema.json(), ["bucket"]
        if packs:
            df, keys = _packed(df, packs), ["bucket", "_bucket"]
        if packs:  # no bounds are sampled: most batches are small; a large folder is dealt to several tasks
            df = df.hint("rebalance", F.col("bucket")).sortWithinPartitions(*keys, *order.get(name, ()))
        elif name in order:  # no number of partitions: adaptive execution follows the volume
            df = df.repartitionByRange(*keys, *order[name]).sortWithinPartitions(*keys, *order[name])
        df.write.options(**BY_TASK).partitionBy("bucket").parquet(path)
        found = _fs(spark, path).listStatus(_path(spark, path))
        names = {s.getPath().getName() for s in found if s.isDirectory()}
        names = {x for x in names if x.startswith("bucket=")}
        held = Counter(packs.values()) if packs else {}
        shared = [Bucket(name, b, f"{path}/bucket={p}", schema, held[p]) for b, p in (packs or {}).items() if f"bucket={p}" in names]
        alone = sorted(names - {f"bucket={p}" for p in held})
        return shared + [Bucket(name, x.removeprefix("bucket="), f"{path}/{x}", schema, 1 if packs else None) for x in alone]

    with ThreadPoolExecutor(len(tables)) as pool:  # the tables are written side by side
        jobs = {name: pool.submit(inheritable_thread_target(spark)(write), name, df) for name, df in tables.items()}
    for name, job in jobs.items():
        kept = any(b.table == name for b in entries)
        entries += job.result() or ([] if kept else [Bucket(name, "", "", tables[name].schema.json())])  # empty: its schema
    _write_pointer(spark, base, number, entries)
    return number


def _packs(buckets: Iterable[str]) -> dict[str, str]:
    """The first of each ``PACK`` buckets in order, for all of them."""
    some = sorted(buckets)
    return {b: some[i - i % PACK] for i, b in enumerate(some)}


def _packed(df: DataFrame, packs: dict[str, str]) -> DataFrame:
    """``bucket`` names the folder, ``_bucket`` the bucket."""
    spark = df.sparkSession
    pairs = F.broadcast(spark.createDataFrame([*packs.items()], "_bucket string, _pack string"))
    rows = df.withColumnRenamed("bucket", "_bucket").join(pairs, "_bucket", "left")
    return rows.select(*[c for c in df.columns if c != "bucket"], "_bucket", F.coalesce("_pack", "_bucket").alias("bucket"))


@contextmanager
def kept(df: DataFrame, base: str) -> Iterator[DataFrame]:
    """``df`` written once beside the tables, for steps that read it more than
    once; its files go at the end."""
    spark, path = df.sparkSession, f"{base.rstrip('/')}/_kept-{uuid.uuid4().hex[:8]}"
    df.write.options(**BY_TASK).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _fs(spark, path).delete(_path(spark, path), True)


def upsert(spark: SparkSession, base: str, key: str, new: dict[str, DataFrame], gone: DataFrame,
           order: dict[str, list[str]]) -> tuple[int, set[str]]:
    """Replace by key (S5): in all tables the rows of every key in ``gone`` and
    in ``new`` go, and the rows of ``new`` come.  All tables hold ``key`` and a
    ``bucket`` that depends on the key's rows in the first table; only buckets
    with rows that go or come are read and written.  Returns the number of the
    set and the touched buckets."""
    now = pointer(spark, base)
    lead = next(iter(new))
    coming = new[lead].select(key, "bucket")
    mine = {t: [b for b in (now[1] if now else []) if b.table == t] for t in new}
    if not all(mine.values()):
        first = {r[0] for r in coming.select("bucket").distinct().collect()}
        return publish(spark, base, new, order, packs=_packs(first)), first
    keys = gone.select(key).unionByName(coming.select(key)).distinct()
    old = _frame(spark, mine[lead]).select(key, "bucket").join(keys, key, "left_semi")
    touched = {r[0] for r in old.select("bucket").unionByName(coming.select("bucket")).distinct().collect()}
    if not touched:
        return now[0], touched
    more = touched | _worn([b for t in new for b in mine[t]], touched)
    out = {}
    for table, df in new.items():
        kept = _frame(spark, mine[table], more).join(keys, key, "left_anti")
        out[table] = kept.unionByName(df.select(kept.columns))
    return publish(spark, base, out, order, more, now, _packs(more)), touched


def _worn(entries: list[Bucket], touched: set[str]) -> set[str]:
    """The buckets that are left in shared folders of which most are gone."""
    left: dict[str, list[Bucket]] = {}
    for b in entries:
        if b.held is not None and b.held >= WORN and b.bucket not in touched:
            left.setdefault(b.path, []).append(b)
    return {b.bucket for some in left.values() if 4 * len(some) < some[0].held for b in some}


def retire(spark: SparkSession, base: str, keep: int = KEEP) -> list[str]:
    """Drop all but the ``keep`` newest whole pointers and the folders that no
    kept pointer names; returns these folders.  Work follows what goes."""
    base = base.rstrip("/")
    whole = [n for n in _numbers(spark, base) if _whole(spark, base, n)]
    old = whole[keep:]
    if not old:
        return []
    of = lambda ns: {b.path for n in ns for b in _entries(spark, base, n)}
    going = sorted(of(old) - of(whole[:keep]) - {""})
    for name in [*(f"{base}/_pointer/set={n}" for n in old), *going]:
        _fs(spark, name).delete(_path(spark, name), True)
    return going
