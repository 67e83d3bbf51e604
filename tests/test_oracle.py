"""Every registered query with a SQL twin matches DuckDB (sf0.001)."""
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_MID, SF_SMALL
from threadlake.sources.driver_tables import TABLES

NAMES = sorted(E.oracle_sql())
# at sf0.001 no session is inside the window of the extraction queries, and every turn has its vector
MAY_BE_EMPTY = {"extract_facts", "fact_classes", "embed_turns"}


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return str(v.to_pydatetime())
    return v


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for _, r in df.iterrows()),
                        key=lambda t: tuple((x is None, str(x)) for x in t))


def _duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def duck():
    return _duck(SF_SMALL)


def _compare(spark, duck, name, sf):
    sdf = E.queries()[name](spark, sf).toPandas()
    ddf = duck.execute(E.oracle_sql()[name]).df()
    c1, r1 = _rows(sdf)
    c2, r2 = _rows(ddf)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
    return r1


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    _compare(spark, duck, name, SF_SMALL)


@pytest.mark.parametrize("name", ["pending_sessions", "pack_transcripts_uncut", "marker_advance", "extract_facts",
                                  "fact_classes", "extraction_report"])
def test_extraction_matches_oracle_with_pending_sessions(spark, name):
    assert _compare(spark, _duck(SF_MID), name, SF_MID)


def test_every_query_runs(spark):
    for name, fn in E.queries().items():
        if name in E.oracle_sql():
            continue
        df = fn(spark, SF_SMALL)
        rows = df.collect()
        assert df.columns and (rows or name in MAY_BE_EMPTY), name


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "score" in df.columns
