"""As-of join and numbering give one answer whatever the partitioning."""
import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_MID
from test_oracle import _rows
from threadlake.operators.asof import asof_join
from threadlake.operators.sessions import number_within
from threadlake.sources.driver_tables import TABLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    return con


@pytest.fixture
def settings(spark):
    """Change settings for one test."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.exchange.reuse")
    old = {n: spark.conf.get(n) for n in names}

    def change(partitions, reuse):
        for n, v in zip(names, (partitions, reuse), strict=True):
            spark.conf.set(n, str(v).lower())

    yield change
    for n, v in old.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("partitions,reuse", [(1, True), (4, False), (4, True), (16, False), (200, True)])
@pytest.mark.parametrize("name", ["bell_latch", "resume_context", "turn_numbering"])
def test_same_answer(spark, duck, settings, name, partitions, reuse):
    settings(partitions, reuse)
    got = _rows(E.queries()[name](spark, SF_MID).toPandas())
    assert got == _rows(duck.execute(E.oracle_sql()[name]).df())


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("bucket_rows", [16, 1 << 14])
def test_against_brute_force(spark, direction, bucket_rows):
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 3, 10)
    rows = [(i, "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 9)}",
             t0 + dt.timedelta(seconds=rnd.randint(0, 20000)), rnd.random() < 0.2) for i in range(3000)]
    rows += [(3000, None, t0, False), (3001, "hot", None, False), (3002, None, t0, True), (3003, "hot", None, True)]
    df = spark.createDataFrame(rows, "id long, key string, ts timestamp_ntz, marker boolean")
    p = df.filter("NOT marker").select(F.col("id").alias("pid"), "key", "ts", F.lit("x").alias("more"))
    m = df.filter("marker").select(F.col("id").alias("mid"), "key", "ts")
    got = {r["pid"]: r["mid"] for r in asof_join(p, m, "key", "ts", "pid", "mid", direction, bucket_rows).collect()}
    marks = [r for r in rows if r[3] and r[1] and r[2]]
    for i, k, ts, marker in rows:
        if marker:
            continue
        near = [(x[2], x[0]) for x in marks if k and ts and x[1] == k and (x[2] <= ts if direction == "backward" else x[2] >= ts)]
        want = (max(near) if direction == "backward" else min(near))[1] if near else None
        assert got[i] == want
    assert len(got) == sum(not r[3] for r in rows)


def test_hot_key_is_split(spark):
    """A key with most rows lands in many buckets, and few exchanges are planned."""
    df = spark.range(40000).select(
        F.col("id"), F.lit("hot").alias("key"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(secs=F.col("id") % 3000)).cast("timestamp_ntz").alias("ts"))
    p = df.select(F.col("id").alias("pid"), "key", "ts")
    m = df.filter("id % 10 = 0").select(F.col("id").alias("mid"), "key", "ts")
    out = asof_join(p, m, "key", "ts", "pid", "mid", bucket_rows=1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 6
    assert out.filter("mid IS NULL").count() < 3000


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbering(spark, settings, partitions):
    settings(partitions, False)
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.5 else f"s{rnd.randint(0, 5)}", v) for v in rnd.sample(range(100000), 4000)]
    df = spark.createDataFrame(rows, "s string, v long")
    got = {(r["s"], r["v"]): r["turn_idx"] for r in number_within(df, "s", ["v"]).collect()}
    for s in {r[0] for r in rows}:
        for i, v in enumerate(sorted(v for k, v in rows if k == s)):
            assert got[(s, v)] == i
