"""DuckDB SQL twins of the registered queries (the correctness oracle).

The model-table CTEs repeat the mapping rules of
``threadlake.sources.driver_tables`` in SQL.
"""

from __future__ import annotations

from threadlake.plans.fts_query import Query, query_rows

TS0 = "TIMESTAMP '2024-01-01 00:00:00'"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"

TURNS_CTE = f"""
turns AS (
  SELECT CAST(conv_id AS VARCHAR) AS session_id, CAST(turn AS INTEGER) AS turn_idx,
         strftime({TS0} + to_hours(conv_id) + to_minutes(turn), {ISO}) AS ts,
         role, text
  FROM conversations)"""

SESSIONS_CTE = f"""
sessions AS (
  SELECT CAST(conv_id AS VARCHAR) AS session_id,
         'p' || CAST(conv_id % 7 AS VARCHAR) AS project,
         CASE WHEN conv_id % 4 = 0 THEN NULL ELSE 'title ' || CAST(conv_id AS VARCHAR) END AS ai_title,
         '/home/dev/p' || CAST(conv_id % 7 AS VARCHAR) AS cwd,
         strftime({TS0} + to_hours(conv_id), {ISO}) AS started_at,
         strftime({TS0} + to_hours(conv_id) + to_minutes(max(turn)), {ISO}) AS ended_at,
         CAST(count(*) AS INTEGER) AS turn_count,
         CASE WHEN conv_id % 5 = 0 THEN 'chat' ELSE 'code' END AS source,
         CASE WHEN conv_id % 11 = 0 THEN NULL ELSE 'n' || CAST(conv_id % 3 AS VARCHAR) END AS node
  FROM conversations GROUP BY conv_id)"""

MODEL = f"{TURNS_CTE},{SESSIONS_CTE}"

TOKENIZE = r"regexp_extract_all(strip_accents(lower({x})), '[\p{{L}}\p{{N}}]+')"


def tok(x: str) -> str:
    return TOKENIZE.format(x=x)


def index_ctes(docs: str = "turns", keys: str = "session_id, turn_idx") -> str:
    return f"""
toks AS (SELECT {keys}, {tok('text')} AS t FROM {docs}),
tokpos AS (SELECT {keys}, len(t) AS doc_len, unnest(t) AS term,
                  unnest(range(len(t))) AS pos FROM toks),
postings AS (SELECT term, {keys}, CAST(count(*) AS INTEGER) AS tf,
                    list(pos ORDER BY pos) AS positions, any_value(doc_len) AS doc_len
             FROM tokpos GROUP BY term, {keys}),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS DOUBLE) / count(*) AS avgdl FROM toks)"""


def _sql_str(s: str | None) -> str:
    if s is None:
        return "NULL"
    return "'" + s.replace("'", "''") + "'"


def _int_list(xs) -> str:
    return "CAST([" + ", ".join(str(int(x)) for x in xs) + "] AS INTEGER[])"


def query_ctes(queries: list[Query]) -> str:
    rows = query_rows(queries)
    ph, cl, qs = [], [], []
    for qid, text, phrases, clauses, lim, proj, src, node in rows:
        for pno, ptext, is_pfx in phrases:
            ph.append(f"({qid}, {pno}, {_sql_str(ptext)}, {'TRUE' if is_pfx else 'FALSE'})")
        for cno, (must, must_not) in enumerate(clauses):
            cl.append(f"({qid}, {cno}, {_int_list(must)}, {_int_list(must_not)})")
        qs.append(f"({qid}, {lim}, {_sql_str(proj)}, {_sql_str(src)}, {_sql_str(node)})")
    return f"""
qph(query_id, pno, ptext, is_prefix) AS (VALUES {', '.join(ph)}),
qcl(query_id, cno, must, must_not) AS (VALUES {', '.join(cl)}),
qry(query_id, lim, project_filter, source_filter, node_filter) AS (VALUES {', '.join(qs)})"""


def score_ctes(keys: str = "session_id, turn_idx") -> str:
    return f"""
qtk AS (SELECT query_id, pno, is_prefix, {tok('ptext')} AS tk FROM qph),
qtok AS (SELECT query_id, pno, is_prefix, len(tk) AS plen, unnest(tk) AS tok,
                unnest(range(len(tk))) AS off FROM qtk),
dict AS (SELECT DISTINCT term FROM postings),
qterms AS (
  SELECT query_id, pno, plen, off, tok AS term FROM qtok WHERE NOT (is_prefix AND off = plen - 1)
  UNION ALL
  SELECT q.query_id, q.pno, q.plen, q.off, d.term FROM qtok q JOIN dict d ON starts_with(d.term, q.tok)
  WHERE q.is_prefix AND q.off = q.plen - 1),
hits AS (SELECT q.query_id, q.pno, q.plen, q.off, p.* EXCLUDE (term)
         FROM qterms q JOIN postings p ON p.term = q.term),
single AS (SELECT query_id, pno, {keys}, CAST(sum(tf) AS BIGINT) AS tf, any_value(doc_len) AS doc_len
           FROM hits WHERE plen = 1 GROUP BY query_id, pno, {keys}),
starts AS (SELECT query_id, pno, plen, {keys}, doc_len, unnest(positions) - off AS start
           FROM hits WHERE plen > 1),
multi AS (SELECT query_id, pno, {keys}, CAST(count(*) AS BIGINT) AS tf, any_value(doc_len) AS doc_len FROM (
            SELECT query_id, pno, {keys}, start, count(*) AS n, any_value(plen) AS plen,
                   any_value(doc_len) AS doc_len
            FROM starts GROUP BY query_id, pno, {keys}, start) WHERE n = plen
          GROUP BY query_id, pno, {keys}),
ph AS (SELECT * FROM single UNION ALL SELECT * FROM multi),
idf AS (SELECT query_id, pno,
               CASE WHEN ln((n_docs - nhit + 0.5) / (nhit + 0.5)) <= 0 THEN 1e-6
                    ELSE ln((n_docs - nhit + 0.5) / (nhit + 0.5)) END AS idf
        FROM (SELECT query_id, pno, count(*) AS nhit FROM ph GROUP BY query_id, pno), corpus),
perdoc AS (SELECT query_id, {keys}, list(DISTINCT pno) AS matched,
                  -sum(idf * (tf * 2.2) / (tf + 1.2 * (0.25 + 0.75 * doc_len / avgdl))) AS score
           FROM ph JOIN idf USING (query_id, pno), corpus GROUP BY query_id, {keys}),
scored AS (SELECT DISTINCT d.query_id, {', '.join('d.' + k.strip() for k in keys.split(','))}, d.score
           FROM perdoc d JOIN qcl c USING (query_id)
           WHERE list_has_all(d.matched, c.must) AND NOT list_has_any(d.matched, c.must_not))"""


def search_sql(queries: list[Query]) -> str:
    return f"""
WITH {MODEL},{index_ctes()},{query_ctes(queries)},{score_ctes()},
cand AS (
  SELECT d.*, s.project, s.ai_title, s.node, q.lim FROM scored d
  JOIN sessions s USING (session_id) JOIN qry q USING (query_id)
  WHERE (q.project_filter IS NULL OR instr(lower(s.project), lower(q.project_filter)) > 0)
    AND (q.source_filter IS NULL OR s.source = q.source_filter)
    AND (q.node_filter IS NULL OR s.node = q.node_filter)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id
                               ORDER BY round(score, 9), session_id, turn_idx) AS rnk FROM cand)
SELECT r.query_id, CAST(r.rnk AS INTEGER) AS rank, r.session_id, r.turn_idx,
       replace(substr(coalesce(t.ts, ''), 1, 19), 'T', ' ') AS ts, t.role, r.project,
       coalesce(r.ai_title, '(no title)') AS title, coalesce(r.node, 'local') AS node,
       round(r.score, 6) AS score
FROM ranked r JOIN turns t USING (session_id, turn_idx)
WHERE r.rnk <= r.lim"""
