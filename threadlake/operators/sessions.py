"""Session reads, listings and statistics.

Skew notes: per-session numbering counts inside ranges of the order column and
shifts them by the counts of earlier ranges, so a session holding
a third of all turns is spread over many tasks instead of one window
partition; prefix lookups pick their match with ``min(struct)`` aggregation,
not a window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlake.functions.indexing import with_global_index
from threadlake.functions.text import contains_ci, cut_body, display_ts, full_trim, prefix_join

# Fixed embeddability rule values.
EMBED_MIN_CHARS = 30
EMBED_SKIP_PREFIXES = ("[tool:", "[result]")
EMBED_ROLES = ("user", "assistant")


# --- numbering / headers ---------------------------------------------------

NUMBERING_WIDTH = 1 << 12


def number_within(df: DataFrame, part: str, order: list[str], name: str = "turn_idx") -> DataFrame:
    """P5: 0-based position of each row inside its ``part`` group, following
    ``order`` (a total order within the group).

    A numeric first order column cuts the group into ranges of
    ``NUMBERING_WIDTH`` values; rows are numbered inside their range and shifted
    by the row counts of earlier ranges (one small row per range)."""
    if dict(df.dtypes)[order[0]] not in ("int", "bigint", "smallint", "tinyint"):
        g = with_global_index(df, [part, *order], "_gidx")
        first = g.groupBy(part).agg(F.min("_gidx").alias("_g0"))
        return g.join(first, part).withColumn(name, (F.col("_gidx") - F.col("_g0")).cast("int")).drop("_gidx", "_g0")
    cut = df.withColumn("_range", F.floor(F.col(order[0]) / NUMBERING_WIDTH))
    earlier = Window.partitionBy(part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = cut.groupBy(part, "_range").agg(F.count(F.lit(1)).alias("_c")).select(
        F.col(part).alias("_p"), F.col("_range").alias("_r"), F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_shift"))
    local = F.row_number().over(Window.partitionBy(part, "_range").orderBy(*order)) - 1
    return (cut.withColumn("_local", local)
            .join(shift, F.col(part).eqNullSafe(F.col("_p")) & F.col("_range").eqNullSafe(F.col("_r")))
            .withColumn(name, (F.col("_shift") + F.col("_local")).cast("int"))
            .drop("_range", "_local", "_p", "_r", "_shift"))


def session_headers(turns: DataFrame) -> DataFrame:
    """Per-session header from its turns (min/max ts, count)."""
    return turns.groupBy("session_id").agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("ended_at"),
        F.count(F.lit(1)).cast("int").alias("turn_count"))


# --- predicates --------------------------------------------------------------

def conj(preds: list[Column | None]) -> Column:
    """AND of the given optional predicates (TRUE when none)."""
    ps = [p for p in preds if p is not None]
    return reduce(lambda a, b: a & b, ps, F.lit(True))


def session_predicate(project: str | None = None, source: str | None = None,
                      node: str | None = None) -> Column:
    """F1 project substring (literal, case-insensitive), F2 source, F3 node."""
    return conj([contains_ci(F.col("project"), project) if project else None,
                 (F.col("source") == source) if source else None,
                 (F.col("node") == node) if node else None])


def embeddable(text: Column | None = None, role: Column | None = None) -> Column:
    """F7 (also used for F8, see ledger): one definition of an embeddable turn."""
    text = F.col("text") if text is None else text
    role = F.col("role") if role is None else role
    t = full_trim(text)
    return (role.isin(*EMBED_ROLES) & (F.length(text) >= EMBED_MIN_CHARS)
            & ~reduce(lambda a, b: a | b, [t.startswith(p) for p in EMBED_SKIP_PREFIXES]))


def usable_for_transcript(text: Column | None = None) -> Column:
    """trimmed length at least 10."""
    text = F.col("text") if text is None else text
    return text.isNotNull() & (F.length(full_trim(text)) >= 10)


def in_recent_window(as_of_ts: Column, hours: int, min_turns: int = 4) -> Column:
    """ended_at > as_of − hours and turn_count ≥ min_turns (UTC)."""
    ended = F.try_to_timestamp(F.col("ended_at"))  # a malformed time is not recent
    cutoff = as_of_ts - F.make_dt_interval(F.lit(0), F.lit(hours))
    return (ended > cutoff) & (F.col("turn_count") >= min_turns)


# --- reads --------------------------------------------------------------------

def resolve_sessions(requests: DataFrame, sessions: DataFrame) -> DataFrame:
    """id exact or prefix; exact match first, then the smallest id.

    requests(request_id, id_or_prefix, …) → + session_id.  Requests are a
    small batch; the prefix test is an equi-join per prefix length.
    """
    ids = sessions.select("session_id")
    cand = prefix_join(ids, "session_id", requests.select("request_id", "id_or_prefix"), "id_or_prefix")
    best = cand.groupBy("request_id").agg(
        F.min(F.struct((F.col("session_id") != F.col("id_or_prefix")).alias("not_exact"),
                       F.col("session_id"))).alias("m"))
    return requests.join(best.select("request_id", F.col("m.session_id").alias("session_id")),
                         "request_id")


def recall_session(requests: DataFrame, sessions: DataFrame, turns: DataFrame,
                   body_chars: int | None = None) -> DataFrame:
    """Header + turns in [idx_from, idx_to] (both optional, inclusive),
    ordered by turn_idx (T5).

    requests(request_id, id_or_prefix, idx_from INT, idx_to INT)
    """
    resolved = resolve_sessions(requests, sessions)
    hdr = resolved.join(sessions, "session_id")
    t = turns.select("session_id", "turn_idx", "ts", "role", "text")
    rng = ((F.col("idx_from").isNull() | (F.col("turn_idx") >= F.col("idx_from")))
           & (F.col("idx_to").isNull() | (F.col("turn_idx") <= F.col("idx_to"))))
    out = hdr.join(t, "session_id").filter(rng)
    text = cut_body(F.col("text"), body_chars) if body_chars else F.col("text")
    return out.select(
        "request_id", "session_id",
        F.coalesce("ai_title", F.lit("(no title)")).alias("title"),
        F.coalesce("node", F.lit("local")).alias("node"), "project", "cwd",
        "started_at", "ended_at", "turn_count", "turn_idx",
        display_ts(F.col("ts")).alias("ts"), "role", text.alias("text")).orderBy("request_id", "turn_idx")


def recent_sessions(sessions: DataFrame, n: int = 10, project: str | None = None,
                    source: str | None = None, node: str | None = None) -> DataFrame:
    """Newest sessions first (ties by id), display columns."""
    f = sessions.filter(session_predicate(project, source, node))
    top = f.orderBy(F.col("started_at").desc_nulls_last(), F.col("session_id")).limit(n)
    return top.select(
        display_ts(F.col("started_at")).alias("started"), "turn_count",
        F.substring("session_id", 1, 8).alias("id8"),
        F.coalesce("node", F.lit("local")).alias("node"),
        F.coalesce("source", F.lit("code")).alias("source"), "project",
        F.substring(F.coalesce("ai_title", F.lit("(no title)")), 1, 60).alias("title"))


# --- statistics ------------------------------------------------------------------

def one_row_join(parts: list[DataFrame]) -> DataFrame:
    """Side by side combination of one-row aggregates (distinct column names):
    union the rows and take each column's non-null value in one aggregate —
    no join is planned."""
    cols = [c for p in parts for c in p.columns]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def session_counts(sessions: DataFrame) -> DataFrame:
    """A1 + A2 (sessions part): one pass over sessions."""
    src = F.col("source")
    return sessions.agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(src.isNull() | (src == "code")).alias("code_sessions"),
        F.count_if(src == "chat").alias("chat_sessions"),
        F.min("started_at").alias("earliest"), F.max("ended_at").alias("latest"))


def per_project(sessions: DataFrame, top: int = 10) -> DataFrame:
    """A3: sessions and turns per project, top ``top`` by session count."""
    g = sessions.groupBy("project").agg(F.count(F.lit(1)).alias("sessions"),
                                        F.sum("turn_count").cast("long").alias("turns"))
    return g.orderBy(F.col("sessions").desc(), F.col("project")).limit(top)


def per_node(sessions: DataFrame) -> DataFrame:
    """A4: sessions per node, NULL counted as 'local'."""
    return (sessions.groupBy(F.coalesce("node", F.lit("local")).alias("node"))
            .agg(F.count(F.lit(1)).alias("sessions")))


def embedding_coverage(turns: DataFrame, vecs: DataFrame) -> DataFrame:
    """A5: embedded / embeddable and percentage (0 when nothing embeddable)."""
    emb = turns.filter(embeddable()).agg(F.count(F.lit(1)).alias("embeddable"))
    done = vecs.agg(F.count(F.lit(1)).alias("embedded"))
    out = one_row_join([done, emb])
    return out.withColumn(
        "embed_pct", F.when(F.col("embeddable") > 0,
                            F.round(F.col("embedded") * 100.0 / F.col("embeddable"), 1))
        .otherwise(F.lit(0.0)))


def edge_counts(edges: DataFrame) -> DataFrame:
    """Edges per type."""
    return edges.groupBy("edge_type").agg(F.count(F.lit(1)).alias("edges"))


def distinct_sessions(turns: DataFrame) -> DataFrame:
    """Distinct sessions that have turns."""
    return turns.select("session_id").distinct()


def index_stats(sessions: DataFrame, turns: DataFrame, vecs: DataFrame,
                edges: DataFrame) -> DataFrame:
    """One-row health summary.

    Every part is a global aggregate (partial aggregation, one row each); the
    one-row results are combined by ``one_row_join`` (union + one aggregate).
    """
    s = session_counts(sessions)
    t = turns.agg(F.count(F.lit(1)).alias("turns"))
    nodes = per_node(sessions).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("sessions")).alias("k"), F.col("node"),
                                             F.col("sessions")))),
        lambda x: F.concat(x["node"], F.lit("="), x["sessions"].cast("string"))), ", ")
        .alias("nodes"))
    cov = embedding_coverage(turns, vecs)
    e = edges.agg(F.count_if(F.col("edge_type") == "TEMPORAL").alias("temporal_edges"),
                  F.count_if(F.col("edge_type") == "SIMILAR_TO").alias("similar_edges"))
    return one_row_join([s, t, nodes, cov, e])
