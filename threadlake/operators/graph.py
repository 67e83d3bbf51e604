"""Turn graph: TEMPORAL edges, BFS expansion and thread recall support.

Edges are ``(src_session_id, src_turn_idx, dst_session_id, dst_turn_idx,
edge_type, weight)``; traversal is undirected.

TEMPORAL edges form one path per session, so expansion around seeds has a
closed form over dense positions (no iteration): every turn within distance
``h`` of a seed is visited after ``h`` hops.  The reference checks its turn cap
*before* each hop, so the final depth is
``h* = min(max_hops, min{h : |visited(h)| ≥ max_turns})``.  Positions come from a
range-partitioned global index (skew-safe), and candidates are generated from
the seeds (``seeds × (2·max_hops+1)`` rows), so a session holding a third of
all turns costs no more than a small one.

For other edge types (SIMILAR_TO) ``bfs_expand`` runs a bounded loop of joins;
each hop's state is cut with a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlake.operators.sessions import number_within, one_row_join
from threadlake.session import cut_lineage

EDGE_COLS = ["src_session_id", "src_turn_idx", "dst_session_id", "dst_turn_idx", "edge_type", "weight"]


def positions(turns: DataFrame) -> DataFrame:
    """(session_id, turn_idx, pos): dense 0-based position in turn_idx order.

    Sessions whose turn numbers are already contiguous (the normal case: ingest
    numbers turns 0..n−1, plus −1 for a summary) get ``turn_idx − min`` from one
    partial-aggregated min/max/count; only the others go through the exact
    distributed numbering."""
    t = turns.select("session_id", "turn_idx")
    st = t.groupBy("session_id").agg(F.min("turn_idx").alias("_lo"), F.max("turn_idx").alias("_hi"),
                                     F.count(F.lit(1)).alias("_n"))
    dense = st.filter(F.col("_hi") - F.col("_lo") + 1 == F.col("_n")).select("session_id", "_lo")
    sparse = st.filter(F.col("_hi") - F.col("_lo") + 1 != F.col("_n")).select("session_id")
    fast = t.join(dense, "session_id").select("session_id", "turn_idx",
                                               (F.col("turn_idx") - F.col("_lo")).cast("int").alias("pos"))
    if sparse.isEmpty():   # one aggregate decides whether the exact numbering is needed at all
        return fast
    slow = number_within(t.join(sparse, "session_id", "left_semi"), "session_id", ["turn_idx"], "pos")
    return fast.unionByName(slow.select("session_id", "turn_idx", "pos"))


def wire_temporal(turns: DataFrame, pos: DataFrame | None = None) -> DataFrame:
    """G1: an edge from each turn to the next turn of its session.

    Implemented as an equi-join on the unique key (session_id, pos + 1), which
    hashes evenly even when one session is huge.
    """
    p = pos if pos is not None else positions(turns)
    a = p.select(F.col("session_id").alias("src_session_id"), F.col("turn_idx").alias("src_turn_idx"),
                 (F.col("pos") + 1).alias("_next"))
    b = p.select(F.col("session_id").alias("dst_session_id"), F.col("turn_idx").alias("dst_turn_idx"),
                 F.col("pos").alias("_next"))
    return (a.join(b, (a.src_session_id == b.dst_session_id) & (a._next == b._next))
            .select("src_session_id", "src_turn_idx", "dst_session_id", "dst_turn_idx",
                    F.lit("TEMPORAL").alias("edge_type"), F.lit(1.0).alias("weight")))


def edge_check(turns: DataFrame, edges: DataFrame) -> DataFrame:
    """Turns, sessions and TEMPORAL edge count (no writes)."""
    t = turns.agg(F.count(F.lit(1)).alias("turns"),
                  F.count_distinct("session_id").alias("sessions"))
    e = edges.agg(F.count_if(F.col("edge_type") == "TEMPORAL").alias("temporal_edges"))
    return one_row_join([t, e])


def temporal_expand(seeds: DataFrame, pos: DataFrame, max_hops: int = 8,
                    max_turns: int = 60) -> DataFrame:
    """G2 closed form.  seeds(query_id, session_id, turn_idx) →
    (query_id, session_id, turn_idx, dist)."""
    n_turns = pos.groupBy("session_id").agg(F.count(F.lit(1)).alias("_n"))
    sp = seeds.select("query_id", "session_id", "turn_idx").join(pos, ["session_id", "turn_idx"])
    cand = sp.select("query_id", "session_id",
                     F.explode(F.sequence(F.col("pos") - max_hops, F.col("pos") + max_hops)).alias("p2"),
                     F.col("pos").alias("_seed_pos"))
    cand = (cand.join(n_turns, "session_id")
            .filter((F.col("p2") >= 0) & (F.col("p2") < F.col("_n")))
            .groupBy("query_id", "session_id", "p2")
            .agg(F.min(F.abs(F.col("p2") - F.col("_seed_pos"))).alias("dist")))
    # cnt(h) per query, cumulative over h; a table of queries × (max_hops+1) rows
    per_h = cand.groupBy("query_id", "dist").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("query_id").orderBy("dist").rowsBetween(Window.unboundedPreceding, 0)
    cum = per_h.withColumn("cnt", F.sum("c").over(w))
    hstar = (cum.groupBy("query_id")
             .agg(F.min(F.when(F.col("cnt") >= max_turns, F.col("dist"))).alias("_hit"))
             .select("query_id", F.least(F.coalesce("_hit", F.lit(max_hops)), F.lit(max_hops)).alias("hstar")))
    kept = cand.join(hstar, "query_id").filter(F.col("dist") <= F.col("hstar"))
    back = pos.select("session_id", F.col("pos").alias("p2"), "turn_idx")
    return kept.join(back, ["session_id", "p2"]).select("query_id", "session_id", "turn_idx", "dist")


def undirected(edges: DataFrame, edge_types: tuple[str, ...]) -> DataFrame:
    e = edges.filter(F.col("edge_type").isin(*edge_types))
    fwd = e.select(F.col("src_session_id").alias("a_s"), F.col("src_turn_idx").alias("a_t"),
                   F.col("dst_session_id").alias("b_s"), F.col("dst_turn_idx").alias("b_t"))
    rev = e.select(F.col("dst_session_id").alias("a_s"), F.col("dst_turn_idx").alias("a_t"),
                   F.col("src_session_id").alias("b_s"), F.col("src_turn_idx").alias("b_t"))
    return fwd.unionByName(rev)


#: Edges of a vertex from which its edges are dealt in parts of this size.
HUB = 100_000


def _adjacent(frontier: DataFrame, und: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """(query_id, session_id, turn_idx) next to the frontier's vertices."""
    f = frontier.select("query_id", F.col("session_id").alias("a_s"), F.col("turn_idx").alias("a_t"))
    key = ["a_s", "a_t"]
    if hubs is not None:  # a hub's edges lie in parts; a frontier row that is one goes to each
        f = f.join(hubs, key, "left").withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        key = [*key, "part"]
    return f.join(und, key).select("query_id", F.col("b_s").alias("session_id"), F.col("b_t").alias("turn_idx"))


def bfs_expand(seeds: DataFrame, edges: DataFrame, max_hops: int = 8, max_turns: int = 60,
               edge_types: tuple[str, ...] = ("TEMPORAL",), hub: int = HUB) -> DataFrame:
    """G2 generic: level-wise undirected expansion for any edge types.

    A query stops before a hop once it has visited ``max_turns`` turns or its
    frontier is empty.  Returns (query_id, session_id, turn_idx, dist).

    Every hop writes its own rows only (reliable checkpoint): what has been
    visited is the union of the hops, and a query's count is added up from a row
    per query and hop.  The edges of a vertex with more than ``hub`` are salted by
    their other end.
    """
    und = undirected(edges, edge_types)
    degree = und.groupBy("a_s", "a_t").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hub)
    hubs = cut_lineage(degree.select("a_s", "a_t", F.ceil(F.col("_n") / hub).cast("int").alias("parts")))
    if hubs.isEmpty():
        hubs = None
        und = cut_lineage(und)
    else:
        part = F.pmod(F.xxhash64("b_s", "b_t"), F.coalesce("parts", F.lit(1))).cast("int")
        und = cut_lineage(und.join(hubs, ["a_s", "a_t"], "left").withColumn("part", part).drop("parts"))
    key = ["query_id", "session_id", "turn_idx"]
    visited = frontier = cut_lineage(seeds.select(*key).distinct().withColumn("dist", F.lit(0)))
    counts = cut_lineage(visited.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")))
    for hop in range(1, max_hops + 1):
        open_q = counts.groupBy("query_id").agg(F.sum("n").alias("n")).filter(F.col("n") < max_turns)
        going = frontier.join(open_q.select("query_id"), "query_id", "left_semi")
        new = _adjacent(going, und, hubs).distinct().join(visited, key, "left_anti").withColumn("dist", F.lit(hop))
        frontier = cut_lineage(new)
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
        counts = counts.unionByName(cut_lineage(frontier.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))))
    return visited
