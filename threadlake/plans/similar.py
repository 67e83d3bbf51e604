"""find_similar (V8): exact KNN over-fetch → join turns/sessions → hybrid
re-rank → per-query top ``limit``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.functions.text import cut_body, display_ts
from threadlake.operators import vectors as V
from threadlake.plans.search import top_k

OVERFETCH = 3  # fixed: candidates = 3 × limit


def find_similar(queries: DataFrame, vecs: DataFrame, turns: DataFrame, sessions: DataFrame,
                 as_of: str, limit: int = 10, chunk: int = 2048) -> DataFrame:
    """queries(query_id, qvec) → ranked turns with hybrid score and its parts.

    The k cut happens before the text join (J3), so only ``3·limit`` rows per
    query meet the turns table.
    """
    cand = V.knn(queries, vecs, OVERFETCH * limit, chunk)
    t = turns.select("session_id", "turn_idx", "ts", "role", "text")
    s = sessions.select("session_id", "ai_title", "project", "started_at", "turn_count")
    j = cand.join(t, ["session_id", "turn_idx"]).join(s, "session_id")
    j = (j.withColumn("rec", V.recency(F.col("started_at"), F.lit(as_of).cast("timestamp")))
         .withColumn("cplx", V.complexity(F.col("turn_count")))
         .withColumn("hybrid", V.hybrid(F.col("cos"), F.col("rec"), F.col("cplx"))))
    ranked = top_k(j, "query_id", [F.round("hybrid", 9).desc(), F.col("knn_rank")], limit)
    return ranked.select(
        "query_id", F.col("rank").cast("int").alias("rank"), "session_id", "turn_idx",
        F.round("hybrid", 6).alias("hybrid"), F.round("cos", 6).alias("sem"),
        F.round("rec", 6).alias("rec"), F.round("cplx", 6).alias("cplx"),
        display_ts(F.col("ts"), 16).alias("ts"), "role", "project",
        F.substring(F.coalesce("ai_title", F.lit("(no title)")), 1, 50).alias("title"),
        cut_body(F.col("text"), 300).alias("body"))
