"""thread_recall (G3): full-text seeds → graph expansion → ordered thread rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlake.functions.text import cut_body, display_ts
from threadlake.operators import graph as G
from threadlake.operators.fulltext import FullTextIndex
from threadlake.plans import search as S
from threadlake.session import cut_lineage


def thread_recall(index: FullTextIndex, queries: DataFrame, turns: DataFrame,
                  sessions: DataFrame, pos: DataFrame | None = None,
                  edges: DataFrame | None = None, max_hops: int = 8, max_turns: int = 60,
                  seed_limit: int = 3, snippet_len: int = 300,
                  edge_types: tuple[str, ...] = ("TEMPORAL",)) -> DataFrame:
    """Rows (query_id, session_id, turn_idx, ts, role, is_match, body, title,
    project, started) for every visited turn whose session exists (J2);
    ``in_order`` numbers them (T4)."""
    # seeds (≤ queries × seed_limit rows) feed three branches; materialise them
    # once (reliable checkpoint) instead of re-running the scoring plan per use
    seeds = cut_lineage(S.seeds(index, queries, seed_limit))
    if edge_types == ("TEMPORAL",):
        if pos is None:
            # only sessions holding a seed can be reached over TEMPORAL edges
            seed_sessions = S.query_side(seeds.select("session_id").distinct())
            pos = G.positions(turns.join(seed_sessions, "session_id", "left_semi"))
        p = pos
        visited = G.temporal_expand(seeds, p, max_hops, max_turns)
    else:
        if edges is None:
            raise ValueError("edges are required for non-TEMPORAL expansion")
        visited = G.bfs_expand(seeds, edges, max_hops, max_turns, edge_types)
    marks = seeds.select("query_id", "session_id", "turn_idx", F.lit(True).alias("_seed"))
    t = turns.select("session_id", "turn_idx", "ts", "role", "text")
    s = sessions.select("session_id", "ai_title", "project", "started_at")
    rows = (visited.join(t, ["session_id", "turn_idx"]).join(s, "session_id")
            .join(marks, ["query_id", "session_id", "turn_idx"], "left"))
    return rows.select(
        "query_id", "session_id", "turn_idx", display_ts(F.col("ts"), 16).alias("ts"), "role",
        F.coalesce("_seed", F.lit(False)).alias("is_match"),
        cut_body(F.col("text"), snippet_len).alias("body"),
        F.coalesce("ai_title", F.lit("(no title)")).alias("title"), "project",
        F.substring(F.coalesce("started_at", F.lit("")), 1, 10).alias("started"),
        F.col("started_at"))


def in_order(thread: DataFrame) -> DataFrame:
    """T4: the rows with their ``place`` in the thread (from 1; by started_at,
    session_id, turn_idx, a total order).  A query's rows follow its max_turns."""
    w = Window.partitionBy("query_id").orderBy("started_at", "session_id", "turn_idx")
    return thread.withColumn("place", F.row_number().over(w))
