"""Expansion over mixed edges against a plain walk."""
import random

from threadlake.operators import graph as G
from threadlake.plans import recall as R


def _walk(seeds, edges, max_hops, max_turns):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    seen = {s: 0 for s in seeds}
    frontier = set(seeds)
    for hop in range(1, max_hops + 1):
        if len(seen) >= max_turns or not frontier:
            break
        frontier = {b for a in frontier for b in near.get(a, ())} - seen.keys()
        seen |= {v: hop for v in frontier}
    return seen


def test_mixed_edges_and_hubs(spark):
    rng = random.Random(3)
    vertex = lambda i: (f"s{i % 12}", i // 12)
    pairs = {(vertex(rng.randrange(150)), vertex(rng.randrange(150))) for _ in range(160)}
    pairs |= {(vertex(7), vertex(i)) for i in range(60, 140)}  # a hub
    rows = [(a[0], a[1], b[0], b[1], rng.choice(["TEMPORAL", "SIMILAR_TO"]), 1.0) for a, b in sorted(pairs)]
    edges = spark.createDataFrame(rows + [("s0", 0, "s1", 1, "OTHER", 1.0)], ", ".join(
        f"{c} {t}" for c, t in zip(G.EDGE_COLS, ["string", "int", "string", "int", "string", "double"])))
    seeds = {1: [vertex(3)], 2: [vertex(7), vertex(20)], 3: [vertex(149)], 4: [("none", 1)]}
    st = spark.createDataFrame([(q, s, t) for q, v in seeds.items() for s, t in v], "query_id int, session_id string, turn_idx int")
    for hops, turns, hub in ((8, 60, 100_000), (3, 10, 5), (5, 1000, 9), (0, 5, 9)):
        got = {}
        for r in G.bfs_expand(st, edges, hops, turns, ("TEMPORAL", "SIMILAR_TO"), hub).collect():
            got.setdefault(r["query_id"], {})[r["session_id"], r["turn_idx"]] = r["dist"]
        assert got == {q: _walk(v, pairs, hops, turns) for q, v in seeds.items()}


def test_thread_order(spark):
    rows = [(1, "b", 0, "2024"), (1, "a", 1, "2024"), (1, "a", 0, "2024"), (1, "c", 0, "2023"), (2, "z", 5, "2020")]
    df = spark.createDataFrame(rows, "query_id int, session_id string, turn_idx int, started_at string")
    got = [(r["query_id"], r["place"], r["session_id"], r["turn_idx"]) for r in R.in_order(df).orderBy("query_id", "place").collect()]
    assert got == [(1, 1, "c", 0), (1, 2, "a", 0), (1, 3, "a", 1), (1, 4, "b", 0), (2, 1, "z", 5)]
