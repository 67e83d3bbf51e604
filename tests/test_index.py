"""Maintained postings (signed generations) and checksummed integrity."""
import glob
import os

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from threadlake.operators import fulltext as FT
from threadlake.plans import fts_query as Q
from threadlake.plans import search as S
from threadlake.sources import driver_tables as D
from threadlake.sources import store


def _state(index):
    p = index.postings.select("term", "session_id", "turn_idx", "tf", F.array_join("positions", ",").alias("pos"), "doc_len")
    return (sorted(map(tuple, p.collect())), sorted(map(tuple, index.term_stats.select("term", "df", "cf").collect())),
            tuple(index.corpus.select("n_docs", "total_len").first()))


def _bytes(path):
    return {p: os.path.getsize(p) for p in glob.glob(f"{path}/*/set=*/bucket=*/*.parquet")}


def test_postings_are_made_inside_the_row(spark, tmp_path):
    """No shuffle by term; rows with the same keys (null too) are one document."""
    rows = [("1", 0, "b a b"), ("1", 1, "É e"), ("2", 0, ""), ("3", 0, None), (None, None, "a")]
    df = lambda r: spark.createDataFrame(r, "session_id string, turn_idx int, text string").repartition(64)
    got = lambda p: sorted(((r["term"], r["session_id"], r["turn_idx"], r["tf"], r["positions"], r["doc_len"])
                            for r in p.collect()), key=str)
    alone = [("a", "1", 0, 1, [1], 3), ("a", None, None, 1, [0], 1), ("b", "1", 0, 2, [0, 2], 3), ("e", "1", 1, 2, [0, 1], 2)]
    p = FT.build_postings(df(rows))
    assert got(p) == sorted(alone, key=str)
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Exchange") <= 2  # the rows dealt out by the test and ``spread``
    twice = FT.build_postings(df(rows + rows))
    assert got(twice) == sorted([(t, s, i, 2 * n, sorted(2 * at), ln) for t, s, i, n, at, ln in alone], key=str)
    path = str(tmp_path)
    FT.FullTextIndex.build(df(rows)).write(path)
    assert got(FT.FullTextIndex.read(spark, path).postings) == sorted(alone, key=str)
    assert not glob.glob(f"{path}/_kept-*")


def test_updates_equal_a_rebuild(spark, tmp_path):
    path, turns = str(tmp_path), D.turns(spark, SF_SMALL).select("session_id", "turn_idx", "text")
    now = turns.filter("session_id not in ('3', '4')")
    FT.FullTextIndex.build(now).write(path)
    steps = [
        ({"3"}, turns.filter("session_id = '3'")),                                        # comes
        ({"5", "6"}, turns.filter("session_id = '5'").withColumn("text", F.concat("text", F.lit(" added zebra")))),  # grows, goes
        ({"5"}, turns.filter("session_id = '5'")),                                        # changes again
        ({"6", "7"}, turns.filter("session_id in ('6', '7')").withColumn("text", F.lit("zebra zebra"))),
    ]
    for keys, new in steps:
        changed = spark.createDataFrame([(k,) for k in keys], "session_id string")
        kept = now.join(changed, "session_id", "left_anti")
        FT.FullTextIndex.update(spark, path, changed, now.filter(F.col("session_id").isin(*keys)), new)
        now = kept.unionByName(new)
        assert _state(FT.FullTextIndex.read(spark, path)) == _state(FT.FullTextIndex.build(now))
        assert FT.suspect_docs(spark, path, now).count() == 0 and FT.check_index(spark, path, now).count() == 0
    idx = FT.FullTextIndex.read(spark, path)
    hits = S.score(idx, Q.query_table(spark, [Q.Query(1, Q.term("zebra"))])).collect()
    assert {(r["session_id"], r["turn_idx"]) for r in hits} == {tuple(r) for r in now.filter("text like '%zebra%'").select(
        "session_id", "turn_idx").collect()}
    FT.FullTextIndex.compact(spark, path)
    assert {b.bucket for b in store.pointer(spark, path)[1]} - {""} == {"g0"}
    assert _state(FT.FullTextIndex.read(spark, path)) == _state(FT.FullTextIndex.build(now))
    assert FT.check_index(spark, path, now).count() == 0


def test_update_writes_in_proportion(spark, tmp_path):
    path, turns = str(tmp_path), D.turns(spark, SF_MID)
    FT.FullTextIndex.build(turns).write(path)
    first = _bytes(path)
    changed = spark.createDataFrame([("17",)], "session_id string")  # 1 % of the sessions
    one = turns.filter("session_id = '17'")
    FT.FullTextIndex.update(spark, path, changed, one, one.withColumn("text", F.concat("text", F.lit(" more"))))
    new = {p: s for p, s in _bytes(path).items() if p not in first}
    assert set(first) <= set(_bytes(path)) and sum(new.values()) < 0.1 * sum(first.values())


def test_only_suspect_ranges_are_looked_into(spark, tmp_path):
    path, turns = str(tmp_path), D.turns(spark, SF_MID)
    FT.FullTextIndex.build(turns).write(path)
    range_of = lambda sid: spark.createDataFrame([(sid,)], "session_id string").select(FT.doc_range("session_id")).first()[0]
    changed = turns.withColumn("text", F.when(F.col("session_id") == "8", F.upper("text")).otherwise(F.col("text")))
    suspects = FT.suspect_docs(spark, path, changed)
    assert {r["dr"] for r in suspects.collect()} == {range_of("8")}
    assert FT.check_index(spark, path, changed).count() == 0   # the same tokens: suspect, but no drift
    drift = turns.filter("not (session_id = '9' and turn_idx = 0)")
    got = {(r["side"], r["session_id"], r["turn_idx"]) for r in FT.check_index(spark, path, drift).collect()}
    assert got == {("stale", "9", 0)}
    # a stored posting that is not what was written
    bad = store.read(spark, path, "postings").withColumn("tf", F.when(
        (F.col("term") == "the") & (F.col("session_id") == "2"), 99).otherwise(F.col("tf")))
    rows = bad.collect()
    assert any(r["tf"] == 99 for r in rows)
    store.publish(spark, path, {"postings": spark.createDataFrame(rows, bad.schema)}, {"postings": ["term"]})
    suspects = FT.suspect_docs(spark, path, turns).collect()
    assert {r["dr"] for r in suspects} == {range_of("2")} and len(suspects) == 1
    got = {(r["side"], r["term"], r["session_id"]) for r in FT.check_index(spark, path, turns).collect()}
    assert got == {("stale", "the", "2"), ("missing", "the", "2")}


def test_terms_are_pushed_into_the_scan(spark, tmp_path):
    path = str(tmp_path)
    FT.FullTextIndex.build(D.turns(spark, SF_SMALL)).write(path)
    idx = FT.FullTextIndex.read(spark, path)
    hits = S.phrase_hits(idx, Q.query_table(spark, [Q.Query(1, Q.any_of(Q.term("the"), Q.term("la")))]))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,la)" in plan and "EqualTo(term,the)" in plan
    assert S.among("x", [f"{i:04d}" for i in range(999)]) is not None


def test_early_stop_gives_the_same_rows(spark, tmp_path):
    path, turns, sessions = str(tmp_path), D.turns(spark, SF_MID), D.sessions(spark, SF_MID)
    FT.FullTextIndex.build(turns).write(path)
    # a second generation: bounds of both must hold
    one = turns.filter("session_id in ('17', '18')")
    FT.FullTextIndex.update(spark, path, one.select("session_id").distinct(), one, one.withColumn("text", F.concat("text", F.lit(" the the"))))
    idx = FT.FullTextIndex.read(spark, path)
    now = turns.withColumn("text", F.when(F.col("session_id").isin("17", "18"), F.concat("text", F.lit(" the the"))).otherwise(F.col("text")))
    words = [r["term"] for r in idx.term_stats.orderBy(F.desc("df"), "term").limit(12).collect()]
    batch = [Q.Query(i, Q.term(w), limit=1 + i % 4) for i, w in enumerate(words)]
    batch += [Q.Query(20 + i, Q.any_of(Q.term(words[i]), Q.term(words[i + 1])), limit=3, source="code" if i % 2 else None) for i in range(4)]
    batch += [Q.Query(30, Q.all_of(Q.term(words[0]), Q.not_(Q.term(words[1]))), limit=2), Q.Query(31, Q.term("nowhere")),
              Q.Query(32, Q.prefix(words[0][:2]), limit=2)]
    qt = Q.query_table(spark, batch)
    rows = lambda early: sorted(map(tuple, S.search_sessions(idx, qt, now, sessions, early=early).select(
        "query_id", "rank", "session_id", "turn_idx", "score").collect()))
    assert rows(True) == rows(False)
    share = {r["query_id"]: (r["postings"], r["looked_at"]) for r in S.early_share(idx, qt, 1).collect()}
    assert sum(b for _, b in share.values()) < 0.6 * sum(a for a, _ in share.values())


def test_prefixes_take_one_scan(spark):
    from threadlake.functions.text import prefix_join
    big = spark.createDataFrame([("ab",), ("abc",), ("b",), ("",), ("ǆa",)], "w string")
    small = spark.createDataFrame([("a",), ("abc",), ("",), (None,), ("ǆ",), ("zz",)], "p string")
    got = prefix_join(big, "w", small, "p")
    want = sorted((b, s) for b in ("ab", "abc", "b", "", "ǆa") for s in ("a", "abc", "", "ǆ", "zz") if b.startswith(s))
    assert sorted(map(tuple, got.collect())) == want
    assert prefix_join(big, "w", small.limit(0), "p").count() == 0
