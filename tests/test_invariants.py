"""Invariants and brute-force checks of the distributed algorithms."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from threadlake.functions.indexing import with_global_index
from threadlake.operators import graph as G
from threadlake.operators import vectors as V
from threadlake.plans import fts_query as Q
from threadlake.sources import driver_tables as D


def test_global_index_matches_row_number(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("abc"), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int")
    g = with_global_index(df, ["k", "v"], "ix", num_partitions=7)
    ref = df.withColumn("ix", F.row_number().over(Window.orderBy("k", "v")) - 1)
    assert g.exceptAll(ref.select(*g.columns)).count() == 0


def test_temporal_edge_count(spark):
    t = D.turns(spark, SF_SMALL)
    n = G.wire_temporal(t).count()
    want = t.groupBy("session_id").count().select(F.sum(F.greatest(F.col("count") - 1, F.lit(0)))).first()[0]
    assert n == want


def test_closed_form_equals_loop(spark):
    t = D.turns(spark, SF_SMALL)
    seeds = (t.select(F.lit(1).cast("long").alias("query_id"), "session_id", "turn_idx")
             .filter((F.col("turn_idx") == 1) & (F.col("session_id").cast("int") % 3 == 0)))
    for hops, cap in [(2, 5), (8, 60), (1, 1000)]:
        a = G.temporal_expand(seeds, G.positions(t), hops, cap).drop("dist")
        b = G.bfs_expand(seeds, G.wire_temporal(t), hops, cap).drop("dist")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lsh_subset_of_exact(spark):
    vecs = D.vecs(spark, SF_SMALL)
    exact = V.wire_similar(vecs, None, 5, 0.35)
    lsh = V.wire_similar_lsh(vecs, None, 5, 0.35)
    keys = ["src_session_id", "src_turn_idx", "dst_session_id", "dst_turn_idx"]
    assert lsh.select(*keys).exceptAll(exact.select(*keys)).count() == 0


def test_dnf():
    q = Q.all_of(Q.term("a"), Q.not_(Q.all_of(Q.term("b"), Q.term("c"))))
    assert sorted((sorted(m), sorted(n)) for m, n in Q.dnf(q)) == [([0], [1]), ([0], [2])]
    try:
        Q.dnf(Q.not_(Q.term("a")))
        raise AssertionError("pure NOT must be rejected")
    except ValueError:
        pass


def test_snippet_marks_hits():
    from threadlake.plans.snippet import snippet_text
    text = " ".join(f"w{i}" for i in range(100)) + " target word here " + " ".join(f"z{i}" for i in range(50))
    s = snippet_text(text, [("target", False)])
    assert ">>>target<<<" in s and s.startswith("...") and s.endswith("...")
    assert snippet_text("Käse und Brot", [("kase", False)]) == ">>>Käse<<< und Brot"


def test_prefix_join_matches_startswith(spark):
    from threadlake.functions.text import prefix_join
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 6))) for _ in range(400)]
    big = spark.createDataFrame([(w,) for w in words], "term string")
    pfx = ["a", "ab", "é", "abc", "zz", "b"]
    small = spark.createDataFrame([(i, p) for i, p in enumerate(pfx)], "qid int, tok string")
    got = sorted((r["qid"], r["term"]) for r in prefix_join(big, "term", small, "tok").collect())
    want = sorted((i, w) for i, p in enumerate(pfx) for w in words if w.startswith(p))
    assert got == want
