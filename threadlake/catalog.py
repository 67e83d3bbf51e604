"""Registered queries: name -> (Spark callable(spark, sf_dir), DuckDB SQL or None).

Each callable reads the driver tables under ``sf_dir`` (or tables Spark derives
from them) in full.  Computed columns carry the same aliases on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlake import oracle as O
from threadlake.session import ensure_checkpoint_dir, ship_package
from threadlake.operators import fulltext as FT
from threadlake.plans import fts_query as Q
from threadlake.plans import search as S
from threadlake.plans import recall as R
from threadlake.operators import sessions as SS
from threadlake.operators import graph as G
from threadlake.sources import driver_tables as D
from threadlake.streaming import pressure as PR
from threadlake.operators import digest as DG
from threadlake.functions.text import full_trim
from threadlake.operators import facts as FX
from threadlake.operators import vectors as V
from threadlake.plans import similar as SIM

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


_INDEXES: dict[tuple[str, str], str] = {}


def index_of(spark: SparkSession, sf_dir: str) -> FT.FullTextIndex:
    """The full-text index of the turns: built once per application and data
    directory, written in the S11 layout under the shared checkpoint folder,
    then read back (searches reuse the written postings instead of re-running
    the build)."""
    from threadlake.session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INDEXES:
        path = scratch_path(spark, "fts-index")
        FT.FullTextIndex.build(D.turns(spark, sf_dir)).write(path)
        _INDEXES[key] = path
    return FT.FullTextIndex.read(spark, _INDEXES[key])


_EDGES: dict[tuple[str, str], str] = {}


def edges_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored edges: wired and written once per application and data
    directory, a bucket per type, then read back."""
    from threadlake.session import scratch_path
    from threadlake.sources import store
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _EDGES:
        base = scratch_path(spark, "edges")
        temporal = G.wire_temporal(D.turns(spark, sf_dir))
        edges = temporal.unionByName(V.wire_similar(vecs_of(spark, sf_dir), temporal))
        store.publish(spark, base, {"edges": edges.withColumn("bucket", F.lower("edge_type"))},
                      {"edges": ["src_session_id", "src_turn_idx"]})
        _EDGES[key] = base
    return store.read(spark, _EDGES[key], "edges").drop("bucket")


# --- full-text index -------------------------------------------------------

@register("fts_tokens", f"""
WITH {O.MODEL}, {O.index_ctes().strip().rstrip(',')}
SELECT session_id, turn_idx, CAST(pos AS INTEGER) AS pos, term AS token FROM tokpos""")
def q_tokens(spark, sf):
    return FT.tokens(D.turns(spark, sf)).select("session_id", "turn_idx", F.col("pos").cast("int").alias("pos"), "token")


#: Accented literals outside Latin-1, composed and decomposed (put behind every turn).
ACCENTED = "Tiếng Việt, ΆΈ, Ёлка, café cafe\u0301s, ṩ x̌y, हिन्दी, Ångström \u212bngstr\u00f6m"


@register("fts_tokens_accented", f"""
WITH {O.MODEL}, a AS (SELECT session_id, turn_idx, text || ' {ACCENTED} ' || role AS text FROM turns),
w AS (SELECT session_id, turn_idx, {O.TOKENIZE.format(x='text')} AS w FROM a)
SELECT session_id, turn_idx, CAST(unnest(range(1, len(w) + 1)) - 1 AS INTEGER) AS pos, unnest(w) AS token FROM w""")
def q_tokens_accented(spark, sf):
    """X1 over all turns with accented words of several scripts added to each."""
    t = D.turns(spark, sf).withColumn("text", F.concat("text", F.lit(f" {ACCENTED} "), "role"))
    return FT.tokens(t).select("session_id", "turn_idx", F.col("pos").cast("int").alias("pos"), "token")


@register("fts_postings", f"""
WITH {O.MODEL}, {O.index_ctes().strip()}
SELECT term, session_id, turn_idx, tf, array_to_string(positions, ',') AS positions, CAST(doc_len AS INTEGER) AS doc_len
FROM postings""")
def q_postings(spark, sf):
    p = index_of(spark, sf).postings
    return p.select("term", "session_id", "turn_idx", "tf",
                    F.array_join("positions", ",").alias("positions"), "doc_len")


@register("fts_term_stats", f"""
WITH {O.MODEL}, {O.index_ctes().strip()}
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM postings GROUP BY term""")
def q_term_stats(spark, sf):
    ts = index_of(spark, sf).term_stats
    return ts.select("term", "df", F.col("cf").cast("long").alias("cf"))


@register("fts_corpus_stats", f"""
WITH {O.MODEL}, {O.index_ctes().strip()}
SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS total_len FROM toks""")
def q_corpus(spark, sf):
    return index_of(spark, sf).corpus


# An index that was built before sessions with id % 5 = 0 came and when those
# with id % 5 = 1 had two turns, then updated with these sessions alone.

_MADE: dict[tuple[str, str, str], str] = {}  # stand-in inputs and stores, one per application and data directory


def _once(spark, sf, name: str, make: Callable[[str], None]) -> str:
    """A scratch folder that ``make`` has filled, made once per application."""
    from threadlake.session import scratch_path
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _MADE:
        path = scratch_path(spark, name)
        make(path)
        _MADE[key] = path
    return _MADE[key]


def _updated_index(spark, sf):
    return FT.FullTextIndex.read(spark, _once(spark, sf, "fts-updated", lambda path: _update_index(spark, sf, path)))


def _update_index(spark, sf, path):
    now = D.turns(spark, sf)
    kind = F.col("session_id").cast("long") % 5
    before = now.filter((kind > 1) | ((kind == 1) & (F.col("turn_idx") < 2)))
    FT.FullTextIndex.build(before).write(path)
    changed = now.filter(kind < 2).select("session_id").distinct()
    FT.FullTextIndex.update(spark, path, changed, before.filter(kind == 1), now.filter(kind < 2))


@register("fts_postings_updated", f"""
WITH {O.MODEL}, {O.index_ctes().strip()}
SELECT term, session_id, turn_idx, tf, array_to_string(positions, ',') AS positions, CAST(doc_len AS INTEGER) AS doc_len
FROM postings""")
def q_postings_updated(spark, sf):
    """After an update the postings are those of a rebuild."""
    p = _updated_index(spark, sf).postings
    return p.select("term", "session_id", "turn_idx", "tf", F.array_join("positions", ",").alias("positions"), "doc_len")


@register("fts_stats_updated", f"""
WITH {O.MODEL}, {O.index_ctes().strip()}
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, (SELECT count(*) FROM toks) AS n_docs,
       (SELECT CAST(sum(len(t)) AS BIGINT) FROM toks) AS total_len FROM postings GROUP BY term""")
def q_stats_updated(spark, sf):
    """Term and corpus statistics after an update, by signed sums."""
    idx = _updated_index(spark, sf)
    stats = idx.term_stats.select("term", "df", F.col("cf").cast("long").alias("cf"))
    return stats.join(F.broadcast(idx.corpus), F.lit(True))


@register("fts_integrity_few", f"""
WITH {O.MODEL},
old_docs AS (SELECT session_id, turn_idx, CASE WHEN CAST(session_id AS BIGINT) % 25 = 0 THEN reverse(text) ELSE text END AS text
             FROM turns WHERE CAST(session_id AS BIGINT) % 25 <> 7),
{O.index_ctes('old_docs').strip()},
cur AS (SELECT {O.tok('text')} AS t, session_id, turn_idx FROM turns),
cur_pos AS (SELECT session_id, turn_idx, unnest(t) AS term, unnest(range(len(t))) AS pos FROM cur),
cur_post AS (SELECT term, session_id, turn_idx, CAST(count(*) AS INTEGER) AS tf,
                    array_to_string(list(pos ORDER BY pos), ',') AS positions
             FROM cur_pos GROUP BY term, session_id, turn_idx),
old_post AS (SELECT term, session_id, turn_idx, tf, array_to_string(positions, ',') AS positions FROM postings)
SELECT *, 'stale' AS side FROM (SELECT * FROM old_post EXCEPT ALL SELECT * FROM cur_post)
UNION ALL
SELECT *, 'missing' AS side FROM (SELECT * FROM cur_post EXCEPT ALL SELECT * FROM old_post)""")
def q_integrity_few(spark, sf):
    """S13 by checksums: sessions with id % 25 = 0 were indexed with another
    text, those with id % 25 = 7 not at all; only their ranges are tokenized."""
    from threadlake.session import scratch_path
    path, turns = scratch_path(spark, "fts-checked"), D.turns(spark, sf)
    kind = F.col("session_id").cast("long") % 25
    before = turns.filter(kind != 7).withColumn("text", F.when(kind == 0, F.reverse("text")).otherwise(F.col("text")))
    FT.FullTextIndex.build(before).write(path)
    return FT.check_index(spark, path, turns)


@register("fts_integrity_drift", f"""
WITH {O.MODEL},
old_docs AS (SELECT * FROM turns WHERE role = 'user'),
{O.index_ctes('old_docs').strip()},
cur AS (SELECT {O.tok('text')} AS t, session_id, turn_idx FROM turns),
cur_pos AS (SELECT session_id, turn_idx, unnest(t) AS term, unnest(range(len(t))) AS pos FROM cur),
cur_post AS (SELECT term, session_id, turn_idx, CAST(count(*) AS INTEGER) AS tf,
                    array_to_string(list(pos ORDER BY pos), ',') AS positions
             FROM cur_pos GROUP BY term, session_id, turn_idx),
old_post AS (SELECT term, session_id, turn_idx, tf, array_to_string(positions, ',') AS positions FROM postings)
SELECT *, 'stale' AS side FROM (SELECT * FROM old_post EXCEPT ALL SELECT * FROM cur_post)
UNION ALL
SELECT *, 'missing' AS side FROM (SELECT * FROM cur_post EXCEPT ALL SELECT * FROM old_post)""")
def q_integrity(spark, sf):
    """An index built before the non-user turns arrived, checked against
    the current turns."""
    turns = D.turns(spark, sf)
    from threadlake.session import scratch_path
    path = scratch_path(spark, "fts-drift")
    FT.FullTextIndex.build(turns.filter(F.col("role") == "user")).write(path)
    return FT.check_index(spark, path, turns)


# --- search ----------------------------------------------------------------

SEARCH_BATCH = [
    Q.Query(1, Q.term("the")),
    Q.Query(2, Q.all_of(Q.term("the"), Q.term("and"))),
    Q.Query(3, Q.any_of(Q.term("der"), Q.term("la"))),
    Q.Query(4, Q.all_of(Q.term("of"), Q.not_(Q.term("the")))),
    Q.Query(5, Q.phrase("of the")),
    Q.Query(6, Q.prefix("tion")),
    Q.Query(7, Q.all_of(Q.phrase("in th"), Q.prefix("wh")), limit=5),
    Q.Query(8, Q.term("die"), limit=20, project="P3", source="code"),
    Q.Query(9, Q.any_of(Q.all_of(Q.term("que"), Q.term("la")), Q.phrase("und die")), node="n1"),
    Q.Query(10, Q.all_of(Q.prefix("th"), Q.not_(Q.any_of(Q.term("a"), Q.term("is")))), limit=15),
]


@register("search_bm25", O.search_sql(SEARCH_BATCH))
def q_search(spark, sf):
    idx = index_of(spark, sf)
    qt = Q.query_table(spark, SEARCH_BATCH)
    out = S.search_sessions(idx, qt, D.turns(spark, sf), D.sessions(spark, sf))
    return out.select("query_id", "rank", "session_id", "turn_idx", "ts", "role", "project",
                      "title", "node", "score")




TERM_BATCH = [
    Q.Query(1, Q.term("was")),
    Q.Query(2, Q.all_of(Q.term("die"), Q.term("und"))),
    Q.Query(3, Q.any_of(Q.term("que"), Q.term("le"), Q.term("of")), limit=7),
    Q.Query(4, Q.all_of(Q.term("the"), Q.not_(Q.term("and")), Q.not_(Q.term("of")))),
]


@register("search_terms_only", O.search_sql(TERM_BATCH))
def q_search_terms(spark, sf):
    """X3/X4 batch of single-term phrases only (the plan leaves out phrase
    alignment and prefix expansion)."""
    idx = index_of(spark, sf)
    qt = Q.query_table(spark, TERM_BATCH)
    out = S.search_sessions(idx, qt, D.turns(spark, sf), D.sessions(spark, sf))
    return out.select("query_id", "rank", "session_id", "turn_idx", "ts", "role", "project",
                      "title", "node", "score")

EARLY_BATCH = TERM_BATCH + [Q.Query(5, Q.term("der"), limit=3), Q.Query(6, Q.any_of(Q.term("the"), Q.term("tion")), limit=2),
                            Q.Query(7, Q.any_of(Q.prefix("ver"), Q.phrase("of the")), limit=6)]


@register("search_early_stop", O.search_sql(EARLY_BATCH))
def q_search_early(spark, sf):
    """X7/T1 with block maxima: blocks that cannot reach the top are skipped."""
    out = S.search_sessions(index_of(spark, sf), Q.query_table(spark, EARLY_BATCH), D.turns(spark, sf),
                            D.sessions(spark, sf), early=True)
    return out.select("query_id", "rank", "session_id", "turn_idx", "ts", "role", "project", "title", "node", "score")


@register("search_snippets")
def q_snippets(spark, sf):
    """X8 on the top-k rows of the search batch (rows-only check)."""
    from threadlake.plans.snippet import add_snippets
    idx = index_of(spark, sf)
    qt = Q.query_table(spark, SEARCH_BATCH)
    hits = S.search_sessions(idx, qt, D.turns(spark, sf), D.sessions(spark, sf))
    return add_snippets(hits, qt).select("query_id", "rank", "session_id", "turn_idx", "snippet")

# --- sessions: numbering, headers, reads, stats -----------------------------

@register("turn_numbering", """
SELECT CAST(conv_id AS VARCHAR) AS session_id, CAST(turn AS INTEGER) AS turn,
       CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS turn_idx
FROM conversations WHERE role IN ('user', 'assistant') AND length(text) > 0""")
def q_turn_numbering(spark, sf):
    """P5: renumber the kept turns (user/assistant, non-empty) 0.. per session."""
    c = D.table(spark, sf, "conversations")
    c = c.filter(F.col("role").isin("user", "assistant") & (F.length("text") > 0))
    c = c.select(F.col("conv_id").cast("string").alias("session_id"), F.col("turn").cast("int").alias("turn"))
    return SS.number_within(c, "session_id", ["turn"], "turn_idx")


@register("session_headers", f"""
WITH {O.MODEL}
SELECT session_id, min(ts) AS started_at, max(ts) AS ended_at, CAST(count(*) AS INTEGER) AS turn_count
FROM turns GROUP BY session_id""")
def q_headers(spark, sf):
    return SS.session_headers(D.turns(spark, sf))


RECENT_COLS = """replace(substr(coalesce(started_at, ''), 1, 19), 'T', ' ') AS started, turn_count,
       substr(session_id, 1, 8) AS id8, coalesce(node, 'local') AS node, coalesce(source, 'code') AS source,
       project, substr(coalesce(ai_title, '(no title)'), 1, 60) AS title"""


@register("recent_sessions", f"""
WITH {O.MODEL}
SELECT {RECENT_COLS} FROM sessions ORDER BY started_at DESC NULLS LAST, session_id LIMIT 10""")
def q_recent(spark, sf):
    return SS.recent_sessions(D.sessions(spark, sf), 10)


@register("recent_sessions_filtered", f"""
WITH {O.MODEL}
SELECT {RECENT_COLS} FROM sessions
WHERE instr(lower(project), 'p3') > 0 AND source = 'code' AND node = 'n1'
ORDER BY started_at DESC NULLS LAST, session_id LIMIT 5""")
def q_recent_f(spark, sf):
    return SS.recent_sessions(D.sessions(spark, sf), 5, project="P3", source="code", node="n1")


RECALL_REQUESTS = [(1, "1", 1, 3), (2, "42", None, None), (3, "7", 2, None), (4, "zzz", None, None),
                   (5, "3", None, 1)]


def _requests_sql() -> str:
    vals = ", ".join(f"({r}, '{p}', {'NULL' if a is None else a}, {'NULL' if b is None else b})"
                     for r, p, a, b in RECALL_REQUESTS)
    return f"req(request_id, id_or_prefix, idx_from, idx_to) AS (VALUES {vals})"


@register("recall_session", f"""
WITH {O.MODEL}, {_requests_sql()},
best AS (SELECT request_id, min({{'ne': session_id <> id_or_prefix, 'sid': session_id}}).sid AS session_id
         FROM req JOIN sessions ON starts_with(session_id, id_or_prefix) GROUP BY request_id)
SELECT r.request_id, s.session_id, coalesce(s.ai_title, '(no title)') AS title,
       coalesce(s.node, 'local') AS node, s.project, s.cwd, s.started_at, s.ended_at, s.turn_count,
       t.turn_idx, replace(substr(coalesce(t.ts, ''), 1, 19), 'T', ' ') AS ts, t.role, t.text
FROM req r JOIN best b USING (request_id) JOIN sessions s USING (session_id) JOIN turns t USING (session_id)
WHERE (r.idx_from IS NULL OR t.turn_idx >= r.idx_from) AND (r.idx_to IS NULL OR t.turn_idx <= r.idx_to)""")
def q_recall(spark, sf):
    req = spark.createDataFrame(RECALL_REQUESTS, "request_id int, id_or_prefix string, idx_from int, idx_to int")
    return SS.recall_session(req, D.sessions(spark, sf), D.turns(spark, sf))


@register("session_counts", f"""
WITH {O.MODEL}
SELECT count(*) AS sessions, count(*) FILTER (WHERE source IS NULL OR source = 'code') AS code_sessions,
       count(*) FILTER (WHERE source = 'chat') AS chat_sessions, min(started_at) AS earliest,
       max(ended_at) AS latest FROM sessions""")
def q_session_counts(spark, sf):
    return SS.session_counts(D.sessions(spark, sf))


@register("project_stats", f"""
WITH {O.MODEL}
SELECT project, count(*) AS sessions, CAST(sum(turn_count) AS BIGINT) AS turns FROM sessions
GROUP BY project ORDER BY sessions DESC, project LIMIT 10""")
def q_project_stats(spark, sf):
    return SS.per_project(D.sessions(spark, sf))


@register("node_stats", f"""
WITH {O.MODEL}
SELECT coalesce(node, 'local') AS node, count(*) AS sessions FROM sessions GROUP BY 1""")
def q_node_stats(spark, sf):
    return SS.per_node(D.sessions(spark, sf))


@register("distinct_sessions", f"""
WITH {O.MODEL}
SELECT DISTINCT session_id FROM turns""")
def q_distinct_sessions(spark, sf):
    return SS.distinct_sessions(D.turns(spark, sf))


EMBEDDABLE_SQL = r"""role IN ('user', 'assistant') AND length(text) >= 30
  AND NOT starts_with(regexp_replace(text, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '[tool:')
  AND NOT starts_with(regexp_replace(text, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '[result]')"""


@register("embeddable_turns", f"""
WITH {O.MODEL}
SELECT session_id, turn_idx FROM turns WHERE {EMBEDDABLE_SQL}""")
def q_embeddable(spark, sf):
    return D.turns(spark, sf).filter(SS.embeddable()).select("session_id", "turn_idx")


@register("usable_turns", f"""
WITH {O.MODEL}
SELECT session_id, turn_idx FROM turns
WHERE text IS NOT NULL AND length(regexp_replace(text, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')) >= 10""")
def q_usable(spark, sf):
    return D.turns(spark, sf).filter(SS.usable_for_transcript()).select("session_id", "turn_idx")


# --- graph -------------------------------------------------------------------

POS_CTE = """pos AS (SELECT session_id, turn_idx,
                 CAST(row_number() OVER (PARTITION BY session_id ORDER BY turn_idx) - 1 AS INTEGER) AS pos FROM turns)"""


@register("temporal_edges", f"""
WITH {O.MODEL}, {POS_CTE}
SELECT a.session_id AS src_session_id, a.turn_idx AS src_turn_idx, b.session_id AS dst_session_id,
       b.turn_idx AS dst_turn_idx, 'TEMPORAL' AS edge_type, 1.0::DOUBLE AS weight
FROM pos a JOIN pos b ON a.session_id = b.session_id AND b.pos = a.pos + 1""")
def q_temporal(spark, sf):
    return G.wire_temporal(D.turns(spark, sf))


@register("edge_check", f"""
WITH {O.MODEL}
SELECT count(*) AS turns, count(DISTINCT session_id) AS sessions,
       count(*) - count(DISTINCT session_id) AS temporal_edges FROM turns""")
def q_edge_check(spark, sf):
    t = D.turns(spark, sf)
    return G.edge_check(t, G.wire_temporal(t))


@register("edge_counts", f"""
WITH {O.MODEL}
SELECT 'TEMPORAL' AS edge_type, count(*) - count(DISTINCT session_id) AS edges FROM turns""")
def q_edge_counts(spark, sf):
    return SS.edge_counts(G.wire_temporal(D.turns(spark, sf)))


THREAD_BATCH = [
    Q.Query(1, Q.phrase("of the")),
    Q.Query(2, Q.all_of(Q.term("die"), Q.term("der"))),
    Q.Query(3, Q.prefix("tion")),
]


def thread_sql(batch, max_hops, max_turns, seed_limit, snippet_len) -> str:
    return f"""
WITH {O.MODEL},{O.index_ctes()},{O.query_ctes(batch)},{O.score_ctes()}, {POS_CTE},
seeds AS (SELECT query_id, session_id, turn_idx FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9), session_id, turn_idx) AS rn
            FROM scored) WHERE rn <= {seed_limit}),
sp AS (SELECT s.query_id, s.session_id, p.pos AS seed_pos FROM seeds s JOIN pos p USING (session_id, turn_idx)),
cand AS (SELECT sp.query_id, p.session_id, p.turn_idx, min(abs(p.pos - sp.seed_pos)) AS dist
         FROM sp JOIN pos p ON p.session_id = sp.session_id AND abs(p.pos - sp.seed_pos) <= {max_hops}
         GROUP BY sp.query_id, p.session_id, p.turn_idx),
per_h AS (SELECT query_id, dist, count(*) AS c FROM cand GROUP BY query_id, dist),
cum AS (SELECT query_id, dist, sum(c) OVER (PARTITION BY query_id ORDER BY dist) AS cnt FROM per_h),
hstar AS (SELECT query_id, least(coalesce(min(dist) FILTER (WHERE cnt >= {max_turns}), {max_hops}), {max_hops}) AS h
          FROM cum GROUP BY query_id)
SELECT c.query_id, c.session_id, c.turn_idx, replace(substr(coalesce(t.ts, ''), 1, 16), 'T', ' ') AS ts, t.role,
       (sd.session_id IS NOT NULL) AS is_match,
       CASE WHEN length(coalesce(t.text, '')) > {snippet_len} THEN substr(t.text, 1, {snippet_len}) || '...'
            ELSE coalesce(t.text, '') END AS body,
       coalesce(s.ai_title, '(no title)') AS title, s.project, substr(coalesce(s.started_at, ''), 1, 10) AS started,
       s.started_at
FROM cand c JOIN hstar h USING (query_id) JOIN turns t USING (session_id, turn_idx)
JOIN sessions s USING (session_id)
LEFT JOIN seeds sd ON sd.query_id = c.query_id AND sd.session_id = c.session_id AND sd.turn_idx = c.turn_idx
WHERE c.dist <= h.h"""


@register("thread_recall", thread_sql(THREAD_BATCH, 8, 60, 3, 300))
def q_thread(spark, sf):
    idx = index_of(spark, sf)
    return R.thread_recall(idx, Q.query_table(spark, THREAD_BATCH), D.turns(spark, sf), D.sessions(spark, sf))


@register("thread_recall_capped", thread_sql(THREAD_BATCH, 3, 4, 3, 80))
def q_thread_capped(spark, sf):
    idx = index_of(spark, sf)
    return R.thread_recall(idx, Q.query_table(spark, THREAD_BATCH), D.turns(spark, sf), D.sessions(spark, sf),
                           max_hops=3, max_turns=4, snippet_len=80)


@register("thread_recall_loop", thread_sql(THREAD_BATCH, 3, 4, 3, 80))
def q_thread_loop(spark, sf):
    """Same as thread_recall_capped through the generic edge-walking loop."""
    idx = index_of(spark, sf)
    t = D.turns(spark, sf)
    return R.thread_recall(idx, Q.query_table(spark, THREAD_BATCH), t, D.sessions(spark, sf),
                           edges=G.wire_temporal(t), max_hops=3, max_turns=4, snippet_len=80,
                           edge_types=("TEMPORAL", "SIMILAR_TO"))



@register("thread_order", f"""
WITH thread AS ({thread_sql(THREAD_BATCH, 8, 60, 3, 300)})
SELECT query_id, session_id, turn_idx,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY started_at, session_id, turn_idx) AS INTEGER) AS place FROM thread""")
def q_thread_order(spark, sf):
    """T4: the thread rows with their place."""
    return R.in_order(q_thread(spark, sf)).select("query_id", "session_id", "turn_idx", "place")


# --- vectors -------------------------------------------------------------------

VECS_CTE = """
vecs AS (SELECT t.session_id, t.turn_idx, e.embedding FROM (
           SELECT CAST(conv_id AS VARCHAR) AS session_id, CAST(turn AS INTEGER) AS turn_idx,
                  row_number() OVER (ORDER BY conv_id, turn) - 1 AS vpos FROM conversations) t
         JOIN embeddings e ON e.vec_id = t.vpos)"""

CENTROIDS_CTE = """
ev AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS d FROM embeddings),
cm AS (SELECT label, d, avg(x) AS m FROM ev GROUP BY label, d),
cl AS (SELECT label, list(m ORDER BY d) AS v FROM cm GROUP BY label),
qv AS (SELECT CAST(label AS BIGINT) AS query_id,
              list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS qvec FROM cl)"""


def _cos_sql(a: str, b: str) -> str:
    return (f"(1.0 - list_sum(list_transform(range(1, len({a}) + 1), "
            f"lambda i: pow({a}[i]::DOUBLE - {b}[i]::DOUBLE, 2))) / 2.0)")


def vecs_of(spark, sf):
    return D.vecs(spark, sf)


@register("vec_normalize", """
WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE /
                 sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE))))  AS v FROM embeddings)
SELECT vec_id, round(sqrt(list_sum(list_transform(v, lambda y: y * y))), 6) AS norm, round(v[1], 6) AS x0,
       len(v) AS dims FROM n""")
def q_vec_normalize(spark, sf):
    from threadlake.functions.vector import norm, normalize
    e = D.table(spark, sf, "embeddings")
    v = e.select("vec_id", normalize(F.col("embedding")).alias("v"))
    return v.select("vec_id", F.round(norm(F.col("v")), 6).alias("norm"),
                    F.round(F.col("v")[0], 6).alias("x0"), F.size("v").alias("dims"))


@register("knn_centroids", f"""
WITH {VECS_CTE},{CENTROIDS_CTE},
pairs AS (SELECT q.query_id, v.session_id, v.turn_idx, {_cos_sql('q.qvec', 'v.embedding')} AS cos FROM qv q, vecs v),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cos, 9) DESC, session_id, turn_idx) AS knn_rank FROM pairs)
SELECT query_id, session_id, turn_idx, round(sqrt(greatest(0, (1 - cos) * 2)), 6) AS distance, round(cos, 6) AS cos,
       CAST(knn_rank AS INTEGER) AS knn_rank
FROM r WHERE knn_rank <= 5""")
def q_knn(spark, sf):
    """V3: 5 nearest turn vectors to each label centroid of the embeddings."""
    q = V.centroids(D.table(spark, sf, "embeddings"), "label", "embedding").select(
        F.col("label").cast("long").alias("query_id"), "qvec")
    out = V.knn(q, vecs_of(spark, sf), 5)
    return out.select("query_id", "session_id", "turn_idx", F.round("distance", 6).alias("distance"),
                      F.round("cos", 6).alias("cos"), F.col("knn_rank").cast("int").alias("knn_rank"))


def similar_sql(k: int, thr: float) -> str:
    return f"""
WITH {O.MODEL}, {VECS_CTE}, {POS_CTE},
temporal AS (SELECT a.session_id AS s1, a.turn_idx AS t1, b.session_id AS s2, b.turn_idx AS t2
             FROM pos a JOIN pos b ON a.session_id = b.session_id AND b.pos = a.pos + 1),
pairs AS (SELECT a.session_id AS src_session_id, a.turn_idx AS src_turn_idx, b.session_id AS dst_session_id,
                 b.turn_idx AS dst_turn_idx, {_cos_sql('a.embedding', 'b.embedding')} AS cos
          FROM vecs a, vecs b),
r AS (SELECT *, row_number() OVER (PARTITION BY src_session_id, src_turn_idx
                 ORDER BY round(cos, 9) DESC,
                          CASE WHEN src_session_id = dst_session_id AND src_turn_idx = dst_turn_idx THEN 0 ELSE 1 END,
                          dst_session_id, dst_turn_idx) AS rk
      FROM pairs WHERE cos >= {thr})
SELECT src_session_id, src_turn_idx, dst_session_id, dst_turn_idx, 'SIMILAR_TO' AS edge_type, round(cos, 6) AS weight
FROM r WHERE rk <= {k + 1} AND NOT (src_session_id = dst_session_id AND src_turn_idx = dst_turn_idx)
  AND NOT EXISTS (SELECT 1 FROM temporal t WHERE (t.s1 = src_session_id AND t.t1 = src_turn_idx
                                                 AND t.s2 = dst_session_id AND t.t2 = dst_turn_idx)
                                             OR (t.s2 = src_session_id AND t.t2 = src_turn_idx
                                                 AND t.s1 = dst_session_id AND t.t1 = dst_turn_idx))"""


@register("similar_edges", similar_sql(5, 0.35))
def q_similar(spark, sf):
    """V5 with threshold 0.35 (no pair of the driver vectors reaches 0.85)."""
    t = D.turns(spark, sf)
    return V.wire_similar(vecs_of(spark, sf), G.wire_temporal(t), k=5, threshold=0.35)


def mixed_thread_sql(batch, max_hops, max_turns, seed_limit, snippet_len, k, threshold) -> str:
    """``thread_sql`` walked hop by hop over TEMPORAL and SIMILAR_TO edges."""
    base = thread_sql(batch, max_hops, max_turns, seed_limit, snippet_len)
    head, rest = base.split("sp AS (SELECT s.query_id", 1)
    tail = rest[rest.index("SELECT c.query_id, c.session_id"):]
    hops = "v0 AS (SELECT DISTINCT query_id, session_id, turn_idx, 0 AS dist FROM seeds)"
    for h in range(1, max_hops + 1):
        hops += f""",
n{h} AS (SELECT DISTINCT f.query_id, u.bs AS session_id, u.bt AS turn_idx, {h} AS dist FROM v{h - 1} f
  JOIN und u ON u.as_ = f.session_id AND u.at_ = f.turn_idx
  WHERE f.dist = {h - 1} AND f.query_id IN (SELECT query_id FROM v{h - 1} GROUP BY query_id HAVING count(*) < {max_turns})
    AND NOT EXISTS (SELECT 1 FROM v{h - 1} o WHERE o.query_id = f.query_id AND o.session_id = u.bs AND o.turn_idx = u.bt)),
v{h} AS (SELECT * FROM v{h - 1} UNION ALL SELECT * FROM n{h})"""
    return head + f"""sim AS ({similar_sql(k, threshold)}),
ed AS (SELECT src_session_id, src_turn_idx, dst_session_id, dst_turn_idx FROM sim
       UNION ALL SELECT a.session_id, a.turn_idx, b.session_id, b.turn_idx
       FROM pos a JOIN pos b ON a.session_id = b.session_id AND b.pos = a.pos + 1),
und AS (SELECT src_session_id AS as_, src_turn_idx AS at_, dst_session_id AS bs, dst_turn_idx AS bt FROM ed
        UNION ALL SELECT dst_session_id, dst_turn_idx, src_session_id, src_turn_idx FROM ed),
{hops},
cand AS (SELECT * FROM v{max_hops}), hstar AS (SELECT DISTINCT query_id, {max_hops} AS h FROM cand)
{tail}"""


@register("thread_recall_mixed", mixed_thread_sql(THREAD_BATCH, 4, 25, 3, 80, 5, 0.35))
def q_thread_mixed(spark, sf):
    """G2/G3 over TEMPORAL and SIMILAR_TO edges together."""
    t = D.turns(spark, sf)
    temporal = G.wire_temporal(t)
    edges = temporal.unionByName(V.wire_similar(vecs_of(spark, sf), temporal, k=5, threshold=0.35))
    return R.thread_recall(index_of(spark, sf), Q.query_table(spark, THREAD_BATCH), t, D.sessions(spark, sf), edges=edges,
                           max_hops=4, max_turns=25, snippet_len=80, edge_types=("TEMPORAL", "SIMILAR_TO"))


@register("similar_edges_default", similar_sql(5, 0.85))
def q_similar_default(spark, sf):
    """V5 with the default K=5, threshold 0.85."""
    t = D.turns(spark, sf)
    return V.wire_similar(vecs_of(spark, sf), G.wire_temporal(t))


@register("similar_edges_lsh")
def q_similar_lsh(spark, sf):
    """V5 approximate (LSH radius join); rows-only check, subset of the exact edges."""
    return V.wire_similar_lsh(vecs_of(spark, sf), G.wire_temporal(D.turns(spark, sf)), k=5, threshold=0.35)


AS_OF_SQL = "TIMESTAMP '2024-12-31 00:00:00'"


def recency_sql(col: str) -> str:
    ts = f"try_strptime({col}, '%Y-%m-%dT%H:%M:%SZ')"
    return (f"CASE WHEN {ts} IS NULL THEN 0.5 ELSE greatest(0.0, 1.0 - greatest(0, floor(epoch({AS_OF_SQL} - {ts}) / 86400)) / 365.0) END")


@register("recency_scores", f"""
WITH {O.MODEL}
SELECT session_id, round({recency_sql('started_at')}, 6) AS rec, round(least(1.0, turn_count / 50.0), 6) AS cplx
FROM sessions""")
def q_recency(spark, sf):
    s = D.sessions(spark, sf)
    return s.select("session_id", F.round(V.recency(F.col("started_at"), F.lit(D.AS_OF).cast("timestamp")), 6).alias("rec"),
                    F.round(V.complexity(F.col("turn_count")), 6).alias("cplx"))


@register("find_similar", f"""
WITH {O.MODEL}, {VECS_CTE},{CENTROIDS_CTE},
pairs AS (SELECT q.query_id, v.session_id, v.turn_idx, {_cos_sql('q.qvec', 'v.embedding')} AS cos FROM qv q, vecs v),
knn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cos, 9) DESC, session_id, turn_idx) AS knn_rank
                       FROM pairs) WHERE knn_rank <= 30),
j AS (SELECT k.*, t.ts, t.role, t.text, s.ai_title, s.project, s.started_at,
             {recency_sql('s.started_at')} AS rec, least(1.0, s.turn_count / 50.0) AS cplx
      FROM knn k JOIN turns t USING (session_id, turn_idx) JOIN sessions s USING (session_id)),
h AS (SELECT *, 0.7 * cos + 0.2 * rec + 0.1 * cplx AS hybrid FROM j),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(hybrid, 9) DESC, knn_rank) AS rnk FROM h)
SELECT query_id, CAST(rnk AS INTEGER) AS rank, session_id, turn_idx, round(hybrid, 6) AS hybrid, round(cos, 6) AS sem,
       round(rec, 6) AS rec, round(cplx, 6) AS cplx, replace(substr(coalesce(ts, ''), 1, 16), 'T', ' ') AS ts, role, project,
       substr(coalesce(ai_title, '(no title)'), 1, 50) AS title,
       CASE WHEN length(coalesce(text, '')) > 300 THEN substr(text, 1, 300) || '...' ELSE coalesce(text, '') END AS body
FROM r WHERE rnk <= 10""")
def q_find_similar(spark, sf):
    """V8: hybrid-ranked turns for each label centroid."""
    q = V.centroids(D.table(spark, sf, "embeddings"), "label", "embedding").select(
        F.col("label").cast("long").alias("query_id"), "qvec")
    return SIM.find_similar(q, vecs_of(spark, sf), D.turns(spark, sf), D.sessions(spark, sf), D.AS_OF, 10)


@register("embed_turns")
def q_embed(spark, sf):
    """V1 with the stand-in hashing encoder (rows-only check)."""
    t = D.turns(spark, sf)
    e = V.embed_turns(t, existing=vecs_of(spark, sf), dims=64)
    from threadlake.functions.vector import norm
    return e.select("session_id", "turn_idx", F.round(norm(F.col("embedding")), 6).alias("norm"))


def _vectors_before(spark, sf):
    """Vectors of an earlier state: turns of sessions with id % 5 = 0 had another
    beginning, those with id % 5 = 1 were not there, some were that are no more."""
    t, kind = D.turns(spark, sf), F.col("session_id").cast("long") % 5
    old = t.filter(kind != 1).withColumn("text", F.when(kind == 0, F.concat(F.lit("before "), "text")).otherwise(F.col("text")))
    gone = t.filter(kind == 2).withColumn("turn_idx", F.col("turn_idx") + 1000)
    return V.embed_turns(old.unionByName(gone), dims=64)


@register("embed_changed_turns", f"""
WITH {O.MODEL}
SELECT session_id, turn_idx, sha256(substr(text, 1, 512)) AS text_hash FROM turns
WHERE {EMBEDDABLE_SQL} AND CAST(session_id AS BIGINT) % 5 < 2""")
def q_embed_changed(spark, sf):
    """Only new and changed texts are embedded."""
    return V.embed_turns(D.turns(spark, sf), _vectors_before(spark, sf), dims=64).select("session_id", "turn_idx", "text_hash")


@register("embeddings_refreshed", f"""
WITH {O.MODEL}
SELECT session_id, turn_idx, sha256(substr(text, 1, 512)) AS text_hash FROM turns WHERE {EMBEDDABLE_SQL}""")
def q_embed_refreshed(spark, sf):
    """V1: the vector table after a refresh has each embeddable turn once, for
    its text of now."""
    return V.refresh_vectors(D.turns(spark, sf), _vectors_before(spark, sf), dims=64).select("session_id", "turn_idx", "text_hash")


@register("embedding_coverage", f"""
WITH {O.MODEL}, {VECS_CTE}
SELECT (SELECT count(*) FROM vecs) AS embedded, (SELECT count(*) FROM turns WHERE {EMBEDDABLE_SQL}) AS embeddable,
       CASE WHEN (SELECT count(*) FROM turns WHERE {EMBEDDABLE_SQL}) > 0
            THEN round((SELECT count(*) FROM vecs) * 100.0 / (SELECT count(*) FROM turns WHERE {EMBEDDABLE_SQL}), 1)
            ELSE 0.0 END AS embed_pct""")
def q_coverage(spark, sf):
    return SS.embedding_coverage(D.turns(spark, sf), vecs_of(spark, sf))



# --- fact extraction -----------------------------------------------------------------

EXTRACT_AS_OF = "2024-01-03T00:00:00Z"
TRIM_SQL = r"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def pending_sql(as_of_sql: str, hours: int, max_sessions: int) -> str:
    return f"""
markers AS (SELECT session_id, 1 AS last_turn_idx FROM sessions WHERE node = 'n1'),
win AS (SELECT s.*, coalesce(m.last_turn_idx, -1) AS since FROM sessions s LEFT JOIN markers m USING (session_id)
        WHERE strptime(ended_at, '%Y-%m-%dT%H:%M:%SZ') > {as_of_sql} - INTERVAL {hours} HOUR AND turn_count >= 4),
pending AS (SELECT session_id, ai_title, node, started_at, ended_at, turn_count, since FROM win
            WHERE since < turn_count - 1 ORDER BY ended_at DESC, session_id LIMIT {max_sessions})"""


def pack_sql(max_chars: int, max_turns: int, chunk: int) -> str:
    return f"""
tt AS (SELECT t.*, p.since FROM turns t JOIN pending p USING (session_id) WHERE t.turn_idx > p.since),
u AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY turn_idx) AS rn, substr(text, 1, {chunk}) AS chunk
      FROM tt WHERE text IS NOT NULL AND length({TRIM_SQL.format(x='text')}) >= 10),
rr AS (SELECT *, sum(length(chunk)) OVER (PARTITION BY session_id ORDER BY turn_idx
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rs FROM u),
kk AS (SELECT *, (rs <= {max_chars} AND rn <= {max_turns}) AS keep FROM rr),
packed AS (SELECT session_id,
                  string_agg('[' || role || ']: ' || chunk, chr(10) || chr(10) ORDER BY turn_idx) FILTER (WHERE keep) AS transcript,
                  count(*) FILTER (WHERE keep) AS n_turns, min(turn_idx) FILTER (WHERE NOT keep) AS first_rejected
           FROM kk GROUP BY session_id),
cut AS (SELECT p.session_id, p.since, k.transcript, k.n_turns, k.first_rejected FROM pending p LEFT JOIN packed k USING (session_id)),
reach AS (SELECT tt.session_id, max(tt.turn_idx) AS reach FROM tt JOIN cut c USING (session_id)
          WHERE c.first_rejected IS NULL OR tt.turn_idx < c.first_rejected GROUP BY tt.session_id),
pack AS (SELECT c.session_id, c.since, coalesce(c.transcript, '') AS transcript, coalesce(c.n_turns, 0) AS n_turns,
                CAST(coalesce(r.reach, c.since) AS INTEGER) AS last_idx,
                length(coalesce(c.transcript, '')) < 200 AS too_short
         FROM cut c LEFT JOIN reach r USING (session_id))"""


EX_AS_OF_SQL = "TIMESTAMP '2024-01-03 00:00:00'"


@register("pending_sessions", f"""
WITH {O.MODEL}, {pending_sql(EX_AS_OF_SQL, 24, 40)}
SELECT * FROM pending""")
def q_pending(spark, sf):
    return FX.pending_sessions(D.sessions(spark, sf), D.markers(spark, sf), EXTRACT_AS_OF, 24)


def _pending(spark, sf):
    return FX.pending_sessions(D.sessions(spark, sf), D.markers(spark, sf), EXTRACT_AS_OF, 24)


@register("pack_transcripts", f"""
WITH {O.MODEL}, {pending_sql(EX_AS_OF_SQL, 24, 40)}, {pack_sql(12000, 150, 2000)}
SELECT * FROM pack""")
def q_pack(spark, sf):
    return FX.pack_transcripts(_pending(spark, sf), D.turns(spark, sf))


@register("pack_transcripts_tight", f"""
WITH {O.MODEL}, {pending_sql(EX_AS_OF_SQL, 24, 40)}, {pack_sql(700, 3, 300)}
SELECT * FROM pack""")
def q_pack_tight(spark, sf):
    """E2 with a small budget (700 chars, 3 turns, 300-char chunks) so the
    overflow rules are exercised by the driver data."""
    return FX.pack_transcripts(_pending(spark, sf), D.turns(spark, sf), 700, 3, 300)


UNCUT = 1_000_000_000  # in the SQL twin only: a limit that nothing reaches


@register("pack_transcripts_uncut", f"""
WITH {O.MODEL}, {pending_sql(EX_AS_OF_SQL, 24, UNCUT)}, {pack_sql(UNCUT, UNCUT, UNCUT)}
SELECT * FROM pack""")
def q_pack_uncut(spark, sf):
    """E2 over every pending session, with all limits off."""
    return FX.pack_transcripts(_pending_all(spark, sf), D.turns(spark, sf), None, None, None)


def _pending_all(spark, sf):
    return FX.pending_sessions(D.sessions(spark, sf), D.markers(spark, sf), EXTRACT_AS_OF, 24, max_sessions=None)


@register("marker_advance", f"""
WITH {O.MODEL}, {pending_sql(EX_AS_OF_SQL, 24, UNCUT)}, {pack_sql(UNCUT, UNCUT, UNCUT)},
legacy AS (SELECT session_id FROM sessions WHERE source = 'chat'),
allm AS (SELECT session_id, last_turn_idx FROM markers
         UNION ALL SELECT session_id, last_idx FROM pack
         UNION ALL SELECT l.session_id, s.turn_count - 1 FROM legacy l JOIN sessions s USING (session_id)
                   WHERE l.session_id NOT IN (SELECT session_id FROM markers))
SELECT session_id, CAST(max(last_turn_idx) AS INTEGER) AS last_turn_idx FROM allm GROUP BY session_id""")
def q_markers(spark, sf):
    """E9 after a run over all pending sessions with the stand-in extractor
    (which never fails), plus legacy migration of chat sessions."""
    packed = FX.pack_transcripts(_pending_all(spark, sf), D.turns(spark, sf), None, None, None)
    replies = FX.extract(packed, FX.stub_extractor)
    return FX.advance_markers(D.markers(spark, sf), packed, replies,
                              D.legacy_sessions(spark, sf), D.sessions(spark, sf))


def _extraction(spark, sf):
    sessions = D.sessions(spark, sf)
    packed = FX.pack_transcripts(_pending_all(spark, sf), D.turns(spark, sf), None, None, None)
    replies = FX.extract(packed, FX.stub_extractor)
    facts = FX.classify_facts(FX.parse_replies(replies))
    rows = FX.memory_rows(facts, sessions, EXTRACT_AS_OF)
    return packed, replies, facts, FX.dedupe(rows)


#: Replies of the stand-in extractor, read as elements and classified.
FACTS_SQL = f"""
WITH {O.MODEL}, {pending_sql(EX_AS_OF_SQL, 24, UNCUT)}, {pack_sql(UNCUT, UNCUT, UNCUT)},
arr AS (SELECT session_id, length(transcript) AS n, string_split(transcript, chr(10) || chr(10)) AS a
        FROM pack WHERE NOT too_short),
el AS (SELECT session_id, n, unnest(range(len(a))) AS i, unnest(a) AS line FROM arr),
el2 AS (SELECT session_id, i, (i + n) % 6 AS kind,
               array_to_string(regexp_extract_all(CASE WHEN contains(line, ']: ') THEN substr(line, strpos(line, ']: ') + 3)
                                                       ELSE line END, '\\S+')[1:2], ' ') AS words FROM el),
facts AS (SELECT session_id, CAST(i AS INTEGER) AS pos,
                 CASE WHEN kind = 5 THEN 'quarantined' WHEN kind IN (3, 4) OR words = '' THEN 'failed'
                      ELSE 'candidate' END AS status,
                 CASE WHEN kind IN (0, 1) THEN {list(FX.FACT_TYPES)}[i % 5 + 1] WHEN kind = 3 THEN 'config'
                      WHEN kind = 4 THEN 'outcome' ELSE 'unknown' END AS type,
                 CASE WHEN kind IN (3, 5) THEN NULL WHEN kind = 4 THEN '' ELSE words END AS fact,
                 CASE WHEN kind IN (0, 1) THEN ['t' || (i % 3)] WHEN kind = 3 THEN ['x']
                      ELSE CAST([] AS VARCHAR[]) END AS tags FROM el2),
mem AS (SELECT f.session_id, pos, '[' || type || '] ' || fact AS content,
               list_concat(tags, ['{FX.SOURCE_TAG}', 'node:' || coalesce(s.node, 'unknown')]) AS tags, s.ended_at
        FROM facts f LEFT JOIN sessions s USING (session_id) WHERE status = 'candidate'),
stored AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY content ORDER BY ended_at DESC, session_id, pos) = 1
                          THEN 'stored' ELSE 'duplicate' END AS status FROM mem)"""


@register("extract_facts", FACTS_SQL + """
SELECT session_id, pos, content, status, tags FROM stored""")
def q_extract(spark, sf):
    """E4–E8 with the stand-in extractor: memory rows and their status."""
    _, _, _, d = _extraction(spark, sf)
    return d.select("session_id", "pos", "content", "status", F.col("metadata.tags").alias("tags"))


@register("fact_classes", FACTS_SQL + " SELECT * FROM facts")
def q_fact_classes(spark, sf):
    """Every parsed reply element with its class."""
    _, _, facts, _ = _extraction(spark, sf)
    return facts


@register("extraction_report", FACTS_SQL + """
SELECT (SELECT count(*) FROM pack) AS sessions, (SELECT count(*) FROM pack WHERE too_short) AS too_short,
       CAST(0 AS BIGINT) AS extract_failed,
       (SELECT count(*) FROM facts) AS extracted, (SELECT count(*) FROM facts WHERE status = 'quarantined') AS quarantined,
       (SELECT count(*) FROM facts WHERE status = 'failed') AS failed,
       (SELECT count(*) FROM stored WHERE status = 'stored') AS stored,
       (SELECT count(*) FROM stored WHERE status = 'duplicate') AS duplicate""")
def q_report(spark, sf):
    """E10 / A9."""
    packed, replies, facts, d = _extraction(spark, sf)
    return FX.run_report(packed, replies, facts, d)


@register("memory_dedupe", """
WITH c AS (SELECT doc_id, '[' || lang || '] ' || text AS content, source FROM documents),
mem AS (SELECT DISTINCT sha256(content) AS h FROM c WHERE source = 'src0'),
f AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id) AS rn FROM c)
SELECT doc_id, CASE WHEN rn = 1 AND sha256(content) NOT IN (SELECT h FROM mem) THEN 'stored' ELSE 'duplicate' END AS status
FROM f""")
def q_dedupe(spark, sf):
    """E8 over the documents corpus: each document is a memory candidate
    (content ``[lang] text``, order by doc_id); documents of source src0 are
    already in memory."""
    docs = D.table(spark, sf, "documents")
    rows = docs.select("doc_id", F.concat(F.lit("["), F.col("lang"), F.lit("] "), F.col("text")).alias("content"),
                       F.struct(F.col("doc_id").alias("k0")).alias("order_key"), "source")
    memory = rows.filter(F.col("source") == "src0").select(F.sha2("content", 256).alias("content_hash"))
    return FX.dedupe(rows.drop("source"), memory).select("doc_id", "status")




@register("index_stats", f"""
WITH {O.MODEL}, {VECS_CTE},
sim AS ({similar_sql(5, 0.85).replace('WITH ', 'WITH ', 1)}),
nodes AS (SELECT string_agg(node || '=' || CAST(n AS VARCHAR), ', ' ORDER BY n DESC, node) AS nodes
          FROM (SELECT coalesce(node, 'local') AS node, count(*) AS n FROM sessions GROUP BY 1)),
emb AS (SELECT (SELECT count(*) FROM vecs) AS embedded,
               (SELECT count(*) FROM turns WHERE {EMBEDDABLE_SQL}) AS embeddable)
SELECT (SELECT count(*) FROM sessions) AS sessions,
       (SELECT count(*) FROM sessions WHERE source IS NULL OR source = 'code') AS code_sessions,
       (SELECT count(*) FROM sessions WHERE source = 'chat') AS chat_sessions,
       (SELECT min(started_at) FROM sessions) AS earliest, (SELECT max(ended_at) FROM sessions) AS latest,
       (SELECT count(*) FROM turns) AS turns, nodes.nodes, emb.embedded, emb.embeddable,
       CASE WHEN emb.embeddable > 0 THEN round(emb.embedded * 100.0 / emb.embeddable, 1) ELSE 0.0 END AS embed_pct,
       (SELECT count(*) - count(DISTINCT session_id) FROM turns) AS temporal_edges,
       (SELECT count(*) FROM sim) AS similar_edges
FROM nodes, emb""")
def q_index_stats(spark, sf):
    """One-row health summary over the stored edges (TEMPORAL ∪
    SIMILAR_TO at the default K=5, threshold 0.85)."""
    return SS.index_stats(D.sessions(spark, sf), D.turns(spark, sf), vecs_of(spark, sf), edges_of(spark, sf))

# --- pressure monitor (batch and streaming) ---------------------------------------------

CONTEXTS = (("purchase", 400), ("view", 300))   # model-name substrings → context size
DEFAULT_CTX = 200

BELLS_SQL_CTE = """
u AS (SELECT event_id, CAST(user_id AS VARCHAR) AS session_id, ts, event_type AS model,
             coalesce(value, 0) + 0.0 + 0 AS tokens FROM events),
mx AS (SELECT *, CASE WHEN contains(model, 'purchase') THEN 400 WHEN contains(model, 'view') THEN 300 ELSE 200 END AS max_tokens FROM u),
px AS (SELECT *, tokens / max_tokens * 100.0 AS pct FROM mx),
bells AS (SELECT event_id, session_id, ts, tokens AS token_count, max_tokens, round(pct * 10.0) / 10.0 AS percentage,
                 unnest(list_filter([70, 85, 95], lambda t: pct >= t)) AS level FROM px)"""

BELLS_SQL = f"WITH {BELLS_SQL_CTE} SELECT * FROM bells"

LATCH_SQL = f"""
WITH {BELLS_SQL_CTE},
st AS (SELECT event_id AS stop_event_id, CAST(user_id AS VARCHAR) AS session_id, ts FROM events WHERE event_type = 'purchase'),
bs AS (SELECT b.*, st.stop_event_id FROM bells b ASOF JOIN st ON b.session_id = st.session_id AND b.ts <= st.ts),
r AS (SELECT *, row_number() OVER (PARTITION BY stop_event_id ORDER BY level DESC, ts DESC, event_id DESC) AS rn FROM bs),
best AS (SELECT * FROM r WHERE rn = 1)
SELECT st.session_id, st.stop_event_id, st.ts, best.level, best.percentage, best.token_count,
       CASE WHEN best.level IS NULL THEN 'periodic' ELSE 'bell_' || CAST(best.level AS VARCHAR) END AS label,
       CASE WHEN coalesce(best.level, 0) >= 95 THEN 'critical' WHEN coalesce(best.level, 0) >= 85 THEN 'pressure'
            ELSE 'none' END AS pressure
FROM st LEFT JOIN best USING (stop_event_id)"""


@register("usage_tokens", """
SELECT event_id, CAST(user_id AS VARCHAR) AS session_id, coalesce(value, 0) + 0.0 + 0 AS tokens FROM events""")
def q_usage(spark, sf):
    return PR.usage_tokens(D.usage_events(spark, sf)).select("event_id", "session_id", "tokens")


@register("pressure_bells", BELLS_SQL)
def q_bells(spark, sf):
    """ST2 + F12 with a fixture context table (purchase 400, view 300, else 200)."""
    return PR.bells(D.usage_events(spark, sf), CONTEXTS, DEFAULT_CTX)


@register("bell_latch", LATCH_SQL)
def q_latch(spark, sf):
    """ST3 / J8 / ST4 (batch, skew-safe as-of)."""
    return PR.latch(PR.bells(D.usage_events(spark, sf), CONTEXTS, DEFAULT_CTX), D.stop_events(spark, sf))


@register("pressure_bells_stream", BELLS_SQL)
def q_bells_stream(spark, sf):
    """ST2 as a Structured Streaming query over the events files."""
    from threadlake.streaming.runner import run_available, table_stream
    stream = PR.bells(D.usage_from_events(table_stream(spark, sf, "events")), CONTEXTS, DEFAULT_CTX)
    return run_available(stream, "bells")


@register("bell_latch_stream", LATCH_SQL)
def q_latch_stream(spark, sf):
    """ST3 as a stateful stream (applyInPandasWithState keyed by session)."""
    from threadlake.streaming.runner import run_available, table_stream
    stream = PR.latch_stream(D.usage_from_events(table_stream(spark, sf, "events")), CONTEXTS, DEFAULT_CTX)
    return run_available(stream, "latch")


# --- digests ---------------------------------------------------------------------------------

def _messages(spark, sf):
    t = D.turns(spark, sf)
    return (t.select("session_id", F.col("turn_idx").alias("pos"), "ts", "role", full_trim(F.col("text")).alias("text"))
            .filter(F.col("text") != ""))


MSG_SQL = f"""
m AS (SELECT session_id, turn_idx AS pos, ts, role, {TRIM_SQL.format(x='text')} AS text FROM turns
      WHERE {TRIM_SQL.format(x='text')} <> '')"""


@register("session_digest", f"""
WITH {O.MODEL}, {MSG_SQL},
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY pos DESC) AS rk FROM m WHERE role = 'user') WHERE rk <= 5),
uu AS (SELECT session_id, string_agg('  [' || substr(coalesce(ts, ''), 1, 16) || '] ' || replace(substr(text, 1, 200), chr(10), ' '),
                                     chr(10) ORDER BY pos) AS recent_user FROM u GROUP BY session_id),
a AS (SELECT session_id, arg_max(ts, pos) AS ats, arg_max(text, pos) AS atext FROM m WHERE role = 'assistant' GROUP BY session_id)
SELECT coalesce(uu.session_id, a.session_id) AS session_id, uu.recent_user,
       substr(a.ats, 1, 16) AS last_assistant_ts, substr(a.atext, 1, 1000) AS last_assistant
FROM uu FULL JOIN a ON uu.session_id = a.session_id""")
def q_digest(spark, sf):
    """D1 (messages part) per session."""
    return DG.user_assistant_digest(_messages(spark, sf))


def _trigger_values() -> str:
    return ", ".join(f"({i}, '{t.replace(chr(39), chr(39) * 2)}')" for i, t in enumerate(DG.CLOSE_TRIGGERS))


@register("close_triggers", f"""
WITH {O.MODEL}, {MSG_SQL},
trig(i, t) AS (VALUES {_trigger_values()}),
lu AS (SELECT session_id, arg_max(text, pos) AS last_user FROM m WHERE role = 'user' GROUP BY session_id)
SELECT session_id, last_user,
       (SELECT t FROM trig WHERE instr(lower(last_user), t) > 0 ORDER BY i LIMIT 1) AS trigger FROM lu""")
def q_triggers(spark, sf):
    """D4 / F11 / W5."""
    return DG.close_triggers(_messages(spark, sf))


@register("resume_context", """
WITH st AS (SELECT event_id, CAST(user_id AS VARCHAR) AS session_id, ts,
                   ['compact', 'resume', 'startup', 'clear'][event_id % 4 + 1] AS source
            FROM events WHERE event_type = 'signup'),
ck AS (SELECT event_id AS ck_id, CAST(user_id AS VARCHAR) AS session_id, ts AS saved_at, props AS ck_body
       FROM events WHERE event_type = 'view'),
sb AS (SELECT CAST(user_id AS VARCHAR) AS session_id, arg_max(props, ts) AS st_body FROM events
       WHERE event_type = 'click' GROUP BY 1),
j AS (SELECT st.*, ck.saved_at, ck.ck_body FROM st ASOF LEFT JOIN ck ON st.session_id = ck.session_id AND st.ts >= ck.saved_at),
k AS (SELECT j.*, sb.st_body,
             CASE WHEN source = 'compact' AND saved_at IS NOT NULL AND (epoch_us(ts) - epoch_us(saved_at)) / 6e7 < 180
                  THEN 'checkpoint'
                  WHEN source IN ('compact', 'resume') AND sb.st_body IS NOT NULL AND sb.st_body <> '' THEN 'state'
                  ELSE 'none' END AS inject
      FROM j LEFT JOIN sb USING (session_id))
SELECT event_id, session_id, ts, source, inject,
       CASE WHEN inject = 'checkpoint' THEN substr(ck_body, 1, 4000) WHEN inject = 'state' THEN substr(st_body, 1, 3000) END AS body
FROM k""")
def q_resume(spark, sf):
    """D5 / J9 (skew-safe as-of join on the checkpoint stream)."""
    return DG.resume_context(D.start_events(spark, sf), D.checkpoints(spark, sf), D.project_state(spark, sf))



# --- raw ingest (JSONL sessions and chat export written by Spark from the tables) ----------

INDEXED_AT = "2024-12-31T00:00:00Z"


def _export_jsonl(spark, sf):
    from threadlake.sources import export as EX
    return _once(spark, sf, "jsonl-export", lambda root: EX.write_jsonl(
        EX.session_lines(D.turns(spark, sf), D.sessions(spark, sf)), root))


def _ingested(spark, sf):
    from threadlake.sources import jsonl as J
    return J.ingest(spark, _export_jsonl(spark, sf), INDEXED_AT, per_node_dirs=True, materialize=True)


INGEST_TURNS_SQL = f"""
WITH {O.MODEL},
k AS (SELECT * FROM turns WHERE role IN ('user', 'assistant'))
SELECT session_id, CAST(row_number() OVER (PARTITION BY session_id ORDER BY turn_idx) - 1 AS INTEGER) AS turn_idx, ts, role,
       CASE WHEN role = 'user' THEN text
            ELSE text || CASE WHEN turn_idx % 3 = 1 THEN chr(10) || '[tool:Edit]' ELSE '' END
                 || chr(10) || '[tool:Bash] step ' || CAST(turn_idx AS VARCHAR) END AS text
FROM k"""


@register("ingest_turns", INGEST_TURNS_SQL)
def q_ingest_turns(spark, sf):
    """Turns read back from per-session JSONL files."""
    return _ingested(spark, sf)["turns"].select("session_id", "turn_idx", "ts", "role", "text")


INGEST_SESSIONS_COLS = """s.session_id, s.project, s.ai_title,
       CASE WHEN a.n_user > 0 THEN s.cwd END AS cwd, a.started_at, a.ended_at, a.turn_count"""

INGEST_AGG = f"""
WITH {O.MODEL},
a AS (SELECT session_id, min(ts) AS started_at, max(ts) AS ended_at, CAST(count(*) AS INTEGER) AS turn_count,
             count(*) FILTER (WHERE role = 'user') AS n_user
      FROM turns WHERE role IN ('user', 'assistant') GROUP BY session_id)"""


@register("ingest_sessions", f"""{INGEST_AGG}
SELECT {INGEST_SESSIONS_COLS}, 'code' AS source, coalesce(s.node, 'local') AS node
FROM sessions s JOIN a USING (session_id)""")
def q_ingest_sessions(spark, sf):
    """Session headers from the JSONL lines (node from the path)."""
    return _ingested(spark, sf)["sessions"].select(
        "session_id", "project", "ai_title", "cwd", "started_at", "ended_at", "turn_count", "source", "node")


@register("ingest_quarantine", """
SELECT CAST(conv_id AS VARCHAR) AS session_id, 'malformed json' AS reason, '{broken' AS line
FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 9 = 0""")
def q_quarantine(spark, sf):
    """Lines set aside (not JSON objects)."""
    return _ingested(spark, sf)["quarantine"].select("session_id", "reason", "line")


FIRST_ERRORS_SQL = """(SELECT array_to_string(list(f ORDER BY f), ' ') FROM (
         SELECT coalesce(s.node, 'local') || '/' || s.project || '/' || s.session_id || '.jsonl' AS f FROM sessions s
         JOIN a USING (session_id) WHERE CAST(s.session_id AS BIGINT) % 9 = 0 AND {which} ORDER BY f LIMIT 10)) AS first_errors"""


def _summary(df):
    """S9 with the paths of ``first_errors`` below the root, in one string."""
    short = F.transform("first_errors", lambda p: F.regexp_extract(p, r"([^/]+/[^/]+/[^/]+)$", 1))
    return df.select("new_or_updated", "unchanged", "errors", "sessions", "turns",
                     F.array_join(short, " ").alias("first_errors"))


@register("ingest_summary", f"""{INGEST_AGG}
SELECT count(*) AS new_or_updated, 0::BIGINT AS unchanged, count(*) FILTER (WHERE CAST(session_id AS BIGINT) % 9 = 0) AS errors,
       count(*) AS sessions, CAST(sum(turn_count) AS BIGINT) AS turns, {FIRST_ERRORS_SQL.format(which='true')} FROM a""")
def q_summary(spark, sf):
    """S9 for a first run (nothing stored yet)."""
    from threadlake.session import scratch_path
    from threadlake.sources import jsonl as J
    root, base = _export_jsonl(spark, sf), scratch_path(spark, "store")
    return _summary(J.ingest_changes(spark, root, base, INDEXED_AT, per_node_dirs=True)["summary"])


# A second run over a folder that grew: sessions with id % 5 = 0 come new, those
# with id % 5 = 1 have grown from their first two turns, the others stay.
SECOND_AGG = INGEST_AGG + """,
e AS (SELECT DISTINCT session_id FROM turns WHERE role IN ('user', 'assistant') AND (turn_idx < 2 OR CAST(session_id AS BIGINT) % 5 <> 1)),
st AS (SELECT a.*, CAST(session_id AS BIGINT) % 5 AS k FROM a)"""


_SECOND: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _second_run(spark, sf):
    """Both runs into one store, once per application; the result of the second."""
    from threadlake.session import scratch_path
    from threadlake.sources import export as EX
    from threadlake.sources import jsonl as J
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SECOND:
        root, base = scratch_path(spark, "jsonl-grows"), scratch_path(spark, "store")
        t, s = D.turns(spark, sf), D.sessions(spark, sf)
        kind = F.col("session_id").cast("long") % 5
        EX.write_jsonl(EX.session_lines(t.filter((kind > 1) | ((kind == 1) & (F.col("turn_idx") < 2))), s.filter(kind > 0)), root)
        J.ingest_changes(spark, root, base, INDEXED_AT, per_node_dirs=True)
        EX.write_jsonl(EX.session_lines(t.filter(kind < 2), s.filter(kind < 2)), root)
        _SECOND[key] = J.ingest_changes(spark, root, base, INDEXED_AT, per_node_dirs=True)
    return _SECOND[key]


@register("ingest_second_summary", f"""{SECOND_AGG}
SELECT count(*) FILTER (k < 2) AS new_or_updated, count(*) FILTER (k > 1) AS unchanged,
       count(*) FILTER (k < 2 AND CAST(session_id AS BIGINT) % 9 = 0) AS errors, count(*) AS sessions,
       CAST(sum(turn_count) AS BIGINT) AS turns, {FIRST_ERRORS_SQL.format(which="CAST(s.session_id AS BIGINT) % 5 < 2")} FROM st""")
def q_second_summary(spark, sf):
    """S9 for a second run: most files are unchanged and not opened."""
    return _summary(_second_run(spark, sf)["summary"])


@register("ingest_second_turns", INGEST_TURNS_SQL)
def q_second_turns(spark, sf):
    """The stored turns after both runs are those of one full run."""
    return _second_run(spark, sf)["turns"].select("session_id", "turn_idx", "ts", "role", "text")


@register("ingest_second_changed", f"""{SECOND_AGG}
SELECT session_id FROM st WHERE k < 2""")
def q_second_changed(spark, sf):
    """S3: the files that the second run reads."""
    return _second_run(spark, sf)["changed"].select("session_id")


ROSTER = ("n0", "n1", "n2", "local", "n9")


@register("node_coverage", f"""
WITH {O.MODEL},
roster(node) AS (VALUES {', '.join(f"('{n}')" for n in ROSTER)}),
f AS (SELECT coalesce(node, 'local') AS node, count(*) + count(*) FILTER (CAST(session_id AS BIGINT) % 10 = 0) AS files
      FROM sessions GROUP BY 1)
SELECT coalesce(r.node, f.node) AS node, coalesce(f.files, 0) AS files,
       CASE WHEN f.files IS NULL THEN 'no transcripts' ELSE 'ok' END AS status
FROM roster r FULL JOIN f ON r.node = f.node""")
def q_coverage_nodes(spark, sf):
    """Files per node, files without a byte included, against a roster (n9
    has none).  No file is opened."""
    from threadlake.session import scratch_path
    from threadlake.sources import export as EX
    from threadlake.sources import jsonl as J
    root = scratch_path(spark, "jsonl-nodes")
    EX.write_jsonl(EX.session_lines(D.turns(spark, sf), D.sessions(spark, sf)), root)
    s = D.sessions(spark, sf).filter(F.col("session_id").cast("long") % 10 == 0)
    EX.touch(s.select(F.coalesce("node", F.lit("local")).alias("node"), "project",
                      F.concat(F.lit("e"), "session_id").alias("session_id")), root)
    roster = spark.createDataFrame([(n,) for n in ROSTER], "node string")
    return J.node_coverage(J.list_files(spark, root, per_node_dirs=True), roster)


@register("upsert_sessions", f"""{INGEST_AGG}
SELECT {INGEST_SESSIONS_COLS}, 'code' AS source,
       CASE WHEN CAST(s.session_id AS BIGINT) % 5 = 0 THEN coalesce(s.node, 'local') ELSE 'local' END AS node
FROM sessions s JOIN a USING (session_id)""")
def q_upsert(spark, sf):
    """An older snapshot (no source/node columns; chat-id sessions
    stale) is brought up to date by replacing the changed sessions."""
    from threadlake.sources import jsonl as J
    root = _export_jsonl(spark, sf)
    fresh = J.ingest(spark, root, INDEXED_AT, per_node_dirs=True, materialize=True)["sessions"]
    stale = F.col("session_id").cast("long") % 5 == 0
    old = fresh.select(
        "session_id", "project", F.when(stale, F.lit("stale title")).otherwise(F.col("ai_title")).alias("ai_title"),
        "cwd", "started_at", "ended_at", "turn_count", "file_path",
        F.when(stale, F.lit(0).cast("timestamp")).otherwise(F.col("file_mtime")).alias("file_mtime"))
    changed = J.changed_files(J.list_files(spark, root, per_node_dirs=True), old)
    new = fresh.join(changed.select("session_id"), "session_id", "left_semi")
    out = J.with_defaults(J.upsert(old, new, changed))
    return out.select("session_id", "project", "ai_title", "cwd", "started_at", "ended_at", "turn_count",
                      "source", "node")


def _chat(spark, sf):
    from threadlake.session import scratch_path
    from threadlake.sources import chat as CH
    from threadlake.sources import export as EX
    root = scratch_path(spark, "chat-export")
    EX.write_chat_export(EX.chat_objects(D.turns(spark, sf), D.sessions(spark, sf)), root)
    return CH.read_export(spark, root)


@register("chat_turns", f"""
WITH {O.MODEL},
c AS (SELECT t.* FROM turns t JOIN sessions s USING (session_id) WHERE s.source = 'chat'),
m AS (SELECT 'c' || session_id AS session_id, turn_idx AS o, ts,
             CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role,
             CASE WHEN role = 'system' THEN '' ELSE text END
             || CASE WHEN turn_idx = 0 THEN chr(10) || '[attachment: notes.txt]' ELSE '' END AS text FROM c),
k AS (SELECT * FROM m WHERE {TRIM_SQL.format(x='text')} <> '')
SELECT session_id, CAST(row_number() OVER (PARTITION BY session_id ORDER BY o) - 1 AS INTEGER) AS turn_idx, ts, role, text FROM k
UNION ALL
SELECT 'c' || session_id, -1, started_at, 'summary', 'summary of ' || session_id FROM sessions
WHERE source = 'chat' AND CAST(session_id AS BIGINT) % 10 = 0""")
def q_chat_turns(spark, sf):
    """Chat-export conversations → turns (summary as turn −1)."""
    from threadlake.sources import chat as CH
    return CH.conversation_turns(_chat(spark, sf))


@register("chat_sessions", f"""
WITH {O.MODEL}
SELECT 'c' || session_id AS session_id, 'chat.export' AS project, coalesce(nullif(ai_title, ''), '(no name)') AS ai_title,
       started_at, ended_at, turn_count,
       epoch(strptime(ended_at, '%Y-%m-%dT%H:%M:%SZ'))::DOUBLE AS file_mtime, 'chat' AS source
FROM sessions WHERE source = 'chat'""")
def q_chat_sessions(spark, sf):
    """Chat session rows (file_mtime = updated-at epoch)."""
    from threadlake.sources import chat as CH
    out = CH.conversation_sessions(_chat(spark, sf), INDEXED_AT)
    return out.select("session_id", "project", "ai_title", "started_at", "ended_at", "turn_count",
                      F.col("file_mtime").cast("double").alias("file_mtime"), "source")



CHAT_LATER = """CASE WHEN CAST(session_id AS BIGINT) % 3 = 0 THEN '2025-01-01T00:00:00Z' ELSE ended_at END"""


def _chat_second(spark, sf):
    """A later export: conversations with id % 15 = 5 come new, those with
    id % 3 = 0 have a later time; and what an earlier run has stored."""
    from threadlake.sources import chat as CH
    later = _chat(spark, sf)
    number = F.substring("uuid", 2, 20).cast("long")
    stored = CH.conversation_sessions(later.filter(number % 15 != 5), INDEXED_AT)
    return stored, later.withColumn("updated_at", F.when(number % 3 == 0, F.lit("2025-01-01T00:00:00Z"))
                                    .otherwise(F.col("updated_at")))


@register("chat_second_changed", f"""
WITH {O.MODEL}
SELECT 'c' || session_id AS session_id, epoch(strptime({CHAT_LATER}, '%Y-%m-%dT%H:%M:%SZ'))::DOUBLE AS file_mtime
FROM sessions WHERE source = 'chat' AND (CAST(session_id AS BIGINT) % 3 = 0 OR CAST(session_id AS BIGINT) % 15 = 5)""")
def q_chat_changed(spark, sf):
    """Conversations that a second run takes."""
    from threadlake.sources import chat as CH
    stored, later = _chat_second(spark, sf)
    return CH.changed_conversations(later, stored).select("session_id", F.col("file_mtime").cast("double").alias("file_mtime"))


@register("chat_second_sessions", f"""
WITH {O.MODEL}
SELECT 'c' || session_id AS session_id, started_at, {CHAT_LATER} AS ended_at, turn_count FROM sessions WHERE source = 'chat'""")
def q_chat_second(spark, sf):
    """The stored chat sessions after the second run."""
    from threadlake.sources import chat as CH
    from threadlake.sources import jsonl as J
    stored, later = _chat_second(spark, sf)
    changed = CH.changed_conversations(later, stored)
    taken = later.join(changed.select(F.col("session_id").alias("uuid")), "uuid", "left_semi")
    out = J.upsert(stored, CH.conversation_sessions(taken, INDEXED_AT), changed)
    return out.select("session_id", "started_at", "ended_at", "turn_count")


RAW_TRIM = TRIM_SQL.format(x="text")


DIGEST_CTES = f"""
WITH {O.MODEL},
ua AS (SELECT * FROM turns WHERE role IN ('user', 'assistant')),
u AS (SELECT session_id, turn_idx AS pos, substr(ts, 1, 16) AS ts, {RAW_TRIM} AS text FROM ua
      WHERE role = 'user' AND {RAW_TRIM} <> ''),
u5 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY pos DESC) AS rk FROM u) WHERE rk <= 5),
uu AS (SELECT session_id, string_agg('  [' || ts || '] ' || replace(substr(text, 1, 200), chr(10), ' '), chr(10) ORDER BY pos)
              AS recent_user FROM u5 GROUP BY session_id),
a AS (SELECT session_id, arg_max(substr(ts, 1, 16), turn_idx) AS last_assistant_ts,
             substr(arg_max({RAW_TRIM}, turn_idx), 1, 1000) AS last_assistant
      FROM ua WHERE role = 'assistant' AND {RAW_TRIM} <> '' GROUP BY session_id),
f AS (SELECT ua.session_id, '/src/' || s.project || '/f' || CAST(turn_idx % 4 AS VARCHAR) || '.py' AS fp, min(turn_idx) AS first
      FROM ua JOIN sessions s USING (session_id) WHERE role = 'assistant' AND turn_idx % 3 = 1 GROUP BY 1, 2),
f20 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY first DESC) AS rk FROM f) WHERE rk <= 20),
ff AS (SELECT session_id, string_agg(fp, chr(10) ORDER BY first) AS files FROM f20 GROUP BY session_id),
o AS (SELECT session_id, turn_idx, 'step ' || CAST(turn_idx AS VARCHAR) AS op FROM ua WHERE role = 'assistant'),
o10 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY turn_idx DESC) AS rk FROM o) WHERE rk <= 10),
oo AS (SELECT session_id, string_agg(op, chr(10) ORDER BY turn_idx) AS ops FROM o10 GROUP BY session_id)"""
DIGEST_JOIN = "FROM uu FULL JOIN a USING (session_id) FULL JOIN ff USING (session_id) FULL JOIN oo USING (session_id)"
DIGEST_SQL = f"{DIGEST_CTES} SELECT session_id, recent_user, last_assistant_ts, last_assistant, files, ops {DIGEST_JOIN}"


def _digest(spark, sf, tool_results=False):
    from threadlake.session import scratch_path
    from threadlake.sources import export as EX
    from threadlake.sources import jsonl as J
    root = scratch_path(spark, "jsonl-export")
    EX.write_jsonl(EX.session_lines(D.turns(spark, sf), D.sessions(spark, sf), tool_results), root)
    read = J.ingest(spark, root, INDEXED_AT, per_node_dirs=True, materialize=True, with_records=True)
    msgs, tools = J.digest_inputs(read["records"])
    return DG.session_digest(msgs, tools)


def _digest_columns(d):
    return d.select("session_id", "recent_user", "last_assistant_ts", "last_assistant",
                    F.array_join("files", "\n").alias("files"), F.array_join("ops", "\n").alias("ops"))


@register("digest_raw", DIGEST_SQL)
def q_digest_raw(spark, sf):
    """D1–D3 / W3–W5 from the raw transcript records."""
    return _digest_columns(_digest(spark, sf))


@register("digest_raw_tool_results", DIGEST_SQL)
def q_digest_tool_results(spark, sf):
    """user lines that are results of tools are no messages: the digest is
    the same with them."""
    return _digest_columns(_digest(spark, sf, tool_results=True))


@register("checkpoint_render", f"""{DIGEST_CTES}
SELECT session_id, concat_ws(chr(10), '=== COMPACTION CHECKPOINT ===', 'Session: ' || session_id, 'Saved:   {INDEXED_AT[:16]}',
  'Trigger: ' || CASE WHEN CAST(session_id AS BIGINT) % 2 = 0 THEN 'auto' ELSE 'manual' END,
  'CWD:     ' || (SELECT cwd FROM sessions s WHERE s.session_id = d.session_id), '', '== RECENT USER MESSAGES (last 5) ==',
  recent_user, '', '== LAST ASSISTANT RESPONSE ==',
  CASE WHEN last_assistant IS NULL THEN '(none recorded)' ELSE '[' || last_assistant_ts || ']' || chr(10) || last_assistant END, '',
  '== FILES TOUCHED THIS SESSION ==' || chr(10) || '  ' || replace(files, chr(10), chr(10) || '  ') || chr(10),
  '== RECENT OPERATIONS ==' || chr(10) || '  - ' || replace(ops, chr(10), chr(10) || '  - ') || chr(10),
  '=== END CHECKPOINT ===') AS checkpoint FROM (SELECT * {DIGEST_JOIN}) d""")
def q_checkpoint_render(spark, sf):
    """D1 rendered as the checkpoint text, with saved, trigger and folder lines."""
    d = _digest(spark, sf).join(D.sessions(spark, sf).select("session_id", "cwd"), "session_id", "left")
    trigger = F.when(F.col("session_id").cast("long") % 2 == 0, F.lit("auto")).otherwise(F.lit("manual"))
    return DG.render_checkpoint(d, INDEXED_AT[:16], trigger, F.col("cwd"))


@register("continuous_ingest", f"""{INGEST_AGG}
SELECT {INGEST_SESSIONS_COLS}, 'code' AS source, coalesce(s.node, 'local') AS node
FROM sessions s JOIN a USING (session_id)""")
def q_continuous(spark, sf):
    """ST5: the JSONL files arrive through a file stream (40 files per
    micro-batch); every batch upserts its buckets of the store."""
    from threadlake.session import scratch_path
    from threadlake.sources import store
    from threadlake.streaming.ingest import start_ingest
    landing = _export_jsonl(spark, sf)
    base = scratch_path(spark, "store")
    q = start_ingest(spark, landing, base, scratch_path(spark, "ingest-ckpt"), INDEXED_AT,
                     available_now=True, files_per_batch=40)
    q.awaitTermination()  # to the end: a store that is read before holds a part of the sessions
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    out = store.read(spark, base, "sessions")
    return out.select("session_id", "project", "ai_title", "cwd", "started_at", "ended_at", "turn_count",
                      "source", "node")


def _prepared(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _prepared(v[0]) for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
