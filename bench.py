"""Headline-job benchmark.

/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.

Each job is forced with a ``noop`` write (full computation, no output cost).
The 100-query search batch is derived from the corpus itself (frequent terms,
term pairs, frequent bigrams as phrases, prefixes), so it grows with the data.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from threadlake.operators import facts as FX  # noqa: E402
from threadlake.operators import fulltext as FT  # noqa: E402
from threadlake.operators import graph as G  # noqa: E402
from threadlake.operators import vectors as V  # noqa: E402
from threadlake.plans import fts_query as Q  # noqa: E402
from threadlake.plans import recall as R  # noqa: E402
from threadlake.plans import search as S  # noqa: E402
from threadlake.plans import similar as SIM  # noqa: E402
from threadlake.session import get_spark, scratch_path  # noqa: E402
from threadlake.sources import driver_tables as D  # noqa: E402
from threadlake.sources import export as EX  # noqa: E402
from threadlake.sources import jsonl as J  # noqa: E402
from threadlake.streaming import pressure as PR  # noqa: E402


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def query_batch(spark, idx: FT.FullTextIndex, n: int = 100) -> list[Q.Query]:
    """100 queries from the corpus: 40 terms, 20 AND, 20 OR, 10 phrases, 10 prefixes."""
    terms = [r["term"] for r in idx.term_stats.filter(F.length("term") >= 2)
             .orderBy(F.col("df").desc(), "term").limit(120).collect()]   # bounded: 120 rows
    toks = FT.tokens(D.turns(spark, SF)).select("session_id", "turn_idx", "pos", "token")
    nxt = toks.select("session_id", "turn_idx", (F.col("pos") - 1).alias("pos"), F.col("token").alias("t2"))
    bigrams = [f'{r["token"]} {r["t2"]}' for r in toks.join(nxt, ["session_id", "turn_idx", "pos"])
               .groupBy("token", "t2").count().orderBy(F.col("count").desc(), "token", "t2").limit(10).collect()]
    out: list[Q.Query] = []
    qid = 0

    def add(expr, **kw):
        nonlocal qid
        qid += 1
        out.append(Q.Query(qid, expr, **kw))

    for t in terms[:40]:
        add(Q.term(t))
    for a, b in zip(terms[40:60], terms[60:80]):
        add(Q.all_of(Q.term(a), Q.term(b)))
    for a, b in zip(terms[80:100], terms[100:120]):
        add(Q.any_of(Q.term(a), Q.term(b)), project="p3")
    for bg in bigrams:
        add(Q.phrase(bg))
    for t in terms[:10]:
        add(Q.prefix(t[:2]))
    return out[:n]


SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("bench", cores=cpus, shuffle_partitions=int(cpus) * 2)
    sf = SF
    turns, sessions = D.turns(spark, sf), D.sessions(spark, sf)
    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        timings[name] = round(time.time() - t0, 3)

    # warm-up on the smallest tables (JIT, Python workers, class loading);
    # untimed but reported as warmup_sec
    t_w = time.time()
    small = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(small):
        wt, ws = D.turns(spark, small), D.sessions(spark, small)
        widx = FT.FullTextIndex.build(wt)
        wq = Q.query_table(spark, [Q.Query(1, Q.all_of(Q.term("the"), Q.prefix("a"))), Q.Query(2, Q.phrase("of the"))])
        force(S.search_sessions(widx, wq, wt, ws))
        force(R.thread_recall(widx, wq, wt, ws))
    force(turns.groupBy("role").count())
    warmup = round(time.time() - t_w, 3)

    idx_holder = {}

    def index_build():
        idx = FT.FullTextIndex.build(turns)
        path = scratch_path(spark, "bench-index")
        idx.write(path)
        idx_holder["idx"] = FT.FullTextIndex.read(spark, path)
    timed("index_build", index_build)
    idx = idx_holder["idx"]
    batch = query_batch(spark, idx)
    qt = Q.query_table(spark, batch)

    timed("search_100", lambda: force(S.search_sessions(idx, qt, turns, sessions)))
    timed("thread_recall_100", lambda: force(R.thread_recall(idx, qt, turns, sessions)))

    vecs = D.vecs(spark, sf)
    temporal = G.wire_temporal(turns)
    timed("temporal_edges", lambda: force(temporal))
    timed("similar_exact", lambda: force(V.wire_similar(vecs, temporal, 5, 0.35)))
    timed("similar_lsh", lambda: force(V.wire_similar_lsh(vecs, temporal, 5, 0.35)))
    cents = V.centroids(D.table(spark, sf, "embeddings"), "label", "embedding").select(
        F.col("label").cast("long").alias("query_id"), "qvec")
    timed("find_similar", lambda: force(SIM.find_similar(cents, vecs, turns, sessions, D.AS_OF, 10)))

    def pack_all():
        pend = FX.pending_sessions(sessions, D.markers(spark, sf), D.AS_OF, hours=24 * 366 * 5,
                                   max_sessions=None)
        force(FX.pack_transcripts(pend, turns))
    timed("pack_transcripts_all", pack_all)

    timed("bell_latch", lambda: force(PR.latch(PR.bells(D.usage_events(spark, sf), (("purchase", 400),), 200),
                                               D.stop_events(spark, sf))))

    root = scratch_path(spark, "bench-jsonl")
    EX.write_jsonl(EX.session_lines(turns, sessions), root)   # fixture, not timed

    def ingest():
        # one listing, one scan and parse, sessions and turns written to their buckets
        J.ingest_changes(spark, root, store, D.AS_OF, per_node_dirs=True)
    store = scratch_path(spark, "bench-store")
    timed("jsonl_ingest", ingest)
    timed("jsonl_ingest_unchanged", ingest)

    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": timings,
                      "sf": float(re.sub(r"[^0-9.]", "", os.path.basename(sf.rstrip("/"))) or 0),
                      "cpus": int(cpus), "n_search_queries": len(batch), "warmup_sec": warmup}))
    spark.stop()


if __name__ == "__main__":
    main()
