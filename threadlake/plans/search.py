"""Batch full-text search: term / boolean / phrase / prefix matching, BM25
ranking, per-query top-k, session filters and display columns (X3–X9, J1, T1).

Plan shape for a batch of Q queries against postings P:

    query phrases (Q·p rows) ─┬─ prefix expansion ⋈ term dictionary (broadcast phrases)
                              └─ exact terms
    query terms ⋈ P on term        (query side is tiny → broadcast hash join; P streams)
    → per (query, phrase, doc) hit counts (phrases: position alignment)
    → per (query, phrase) doc counts → idf
    → per (query, doc) BM25 + matched phrase set → DNF filter
    → ⋈ sessions (filters) → row_number ≤ limit per query (WindowGroupLimit does
      a partial top-k before the shuffle, so a query matching a third of the
      corpus ships only k rows per partition)
    → ⋈ turns for display columns, only for the k survivors.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlake.functions.text import contains_ci, display_ts, prefix_join, tokenize
from threadlake.operators.fulltext import FullTextIndex, average_length, weight
from threadlake.session import cut_lineage

# Fixed value (as FTS5 has it).
IDF_FLOOR = 1e-6


def query_terms(index: FullTextIndex, queries: DataFrame,
                has_prefix: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """(exact, expanded): (query_id, pno, plen, off, term) for every query
    token.  ``exact`` holds the literal tokens (size bounded by the batch);
    ``expanded`` the dictionary terms matching prefix tokens (size depends on
    the dictionary, so the planner sizes that join itself)."""
    ph = queries.select("query_id", F.explode("phrases").alias("ph"))
    ph = ph.select("query_id", F.col("ph.pno").alias("pno"), F.col("ph.prefix").alias("prefix"),
                   tokenize(F.col("ph.text")).alias("toks"))
    qtok = ph.select("query_id", "pno", "prefix", F.size("toks").alias("plen"),
                     F.posexplode("toks").alias("off", "tok"))
    is_pfx = F.col("prefix") & (F.col("off") == F.col("plen") - 1)
    exact = qtok.filter(~is_pfx).select("query_id", "pno", "plen", "off", F.col("tok").alias("term"))
    if not has_prefix:
        return exact, None
    pfx = qtok.filter(is_pfx).select("query_id", "pno", "plen", "off", "tok")
    # the dictionary lies sorted by term: the scan keeps to the prefixes' ranges
    dictionary = index.term_stats.select("term").filter(beginning("term", prefixes_of(queries)))
    expanded = prefix_join(dictionary, "term", pfx, "tok").select("query_id", "pno", "plen", "off", "term")
    return exact, expanded


def prefixes_of(queries: DataFrame) -> list[str]:
    """Last tokens of the batch's prefix phrases (bounded by the batch)."""
    ph = queries.select(F.explode("phrases").alias("ph")).filter("ph.prefix")
    return sorted({r[0] for r in ph.select(F.element_at(tokenize(F.col("ph.text")), -1)).distinct().collect() if r[0]})


def beginning(column: str, prefixes: list[str]) -> Column:
    """A filter that holds for all that begins with one of the sorted
    ``prefixes``, in a form that Parquet statistics can use."""
    if not prefixes:
        return F.lit(False)
    if len(prefixes) > PUSHED_TERMS:
        return F.col(column) >= prefixes[0]
    return reduce(or_, [F.col(column).startswith(p) for p in prefixes])


def batch_shape(queries: DataFrame) -> tuple[bool, bool]:
    """(has_prefix, has_multi_token_phrase) of a query batch — one tiny
    action on the driver-built query table; lets plans leave out branches a
    batch does not need."""
    ph = queries.select(F.explode("phrases").alias("ph"))
    row = ph.agg(F.max(F.col("ph.prefix").cast("int")).alias("p"),
                 F.max(F.size(tokenize(F.col("ph.text")))).alias("n")).first()
    return bool(row["p"] or 0), int(row["n"] or 0) > 1


#: Terms that are pushed into the scan one by one; of more, their range is (and
#: rows are looked up in a set, not compared with each).
PUSHED_TERMS = 16
#: Terms of a batch that make a set; of more only the range is a filter.
MOST_TERMS = 10_000


def batch_terms(queries: DataFrame) -> list[str]:
    """Distinct tokens of a query batch (bounded by the batch, which the driver
    built)."""
    toks = queries.select(F.explode("phrases").alias("ph")).select(F.explode(tokenize(F.col("ph.text"))).alias("t"))
    return sorted(r[0] for r in toks.distinct().collect())


def among(column: str, values: list[str]) -> Column:
    """A filter that holds for all of the sorted ``values``, in a form that
    Parquet statistics can use: equalities, or the range of many values (the
    join behind it is exact)."""
    c = F.col(column)
    if not values:
        return F.lit(False)
    if len(values) > PUSHED_TERMS:
        return c.isin(values) if len(values) <= MOST_TERMS else (c >= values[0]) & (c <= values[-1])
    return reduce(or_, [c == v for v in values])


def phrase_hits(index: FullTextIndex, queries: DataFrame, shape: tuple[bool, bool] | None = None) -> DataFrame:
    """(query_id, pno, <keys>, tf, doc_len): phrase occurrences per document."""
    keys = list(index.keys)
    has_prefix, has_multi = shape if shape is not None else batch_shape(queries)
    exact, expanded = query_terms(index, query_side(queries), has_prefix)
    # build side = the query terms, never the postings (which only look small
    # to the planner on small corpora); the terms of the batch are also a filter
    # of the scan, which skips the row groups of all others
    hits = F.broadcast(exact).join(index.postings.filter(among("term", batch_terms(queries))), "term")
    if expanded is not None:
        hits = hits.unionByName(expanded.join(index.postings, "term").select(hits.columns))
    single = (hits.filter(F.col("plen") == 1)
              .groupBy("query_id", "pno", *keys)
              .agg(F.sum("tf").cast("long").alias("tf"), F.first("doc_len").alias("doc_len")))
    if not has_multi:
        return single
    multi = (hits.filter(F.col("plen") > 1)
             .select("query_id", "pno", "plen", "off", *keys, "doc_len",
                     F.explode("positions").alias("pos"))
             .withColumn("start", F.col("pos") - F.col("off"))
             .groupBy("query_id", "pno", *keys, "start")
             .agg(F.count(F.lit(1)).alias("n"), F.first("plen").alias("plen"),
                  F.first("doc_len").alias("doc_len"))
             .filter(F.col("n") == F.col("plen"))
             .groupBy("query_id", "pno", *keys)
             .agg(F.count(F.lit(1)).alias("tf"), F.first("doc_len").alias("doc_len")))
    return single.unionByName(multi)


def clause_match(matched: Column, clauses: Column) -> Column:
    """True when some DNF clause has all its must phrases and none of its
    must_not phrases in ``matched``."""
    return F.exists(clauses, lambda c: F.forall(c["must"], lambda p: F.array_contains(matched, p))
                    & ~F.exists(c["must_not"], lambda p: F.array_contains(matched, p)))


#: Queries that are broadcast at most; a larger batch is joined as it comes.
BROADCAST_QUERIES = 100_000


def query_side(queries: DataFrame) -> DataFrame:
    """The batch, marked for broadcast after its size is checked."""
    small = queries.limit(BROADCAST_QUERIES + 1).count() <= BROADCAST_QUERIES
    return F.broadcast(queries) if small else queries


def phrase_idf(index: FullTextIndex, queries: DataFrame, hits: DataFrame, n_docs: int,
               needs_counts: bool = True) -> DataFrame:
    """(query_id, pno, idf).  A single exact term's document count is its
    ``df`` from the term dictionary, so only prefix and multi-token phrases
    need a count over the hits."""
    ph = queries.select("query_id", F.explode("phrases").alias("ph")).select(
        "query_id", F.col("ph.pno").alias("pno"), F.col("ph.prefix").alias("prefix"),
        tokenize(F.col("ph.text")).alias("toks"))
    simple = ph.filter(~F.col("prefix") & (F.size("toks") == 1)).select(
        "query_id", "pno", F.col("toks")[0].alias("term"))
    simple_n = (F.broadcast(simple).join(index.term_stats.select("term", F.col("df").alias("nhit")), "term")
                .select("query_id", "pno", "nhit"))
    nhit = simple_n
    if needs_counts:   # prefix or multi-token phrases: count documents over the hits
        complex_keys = ph.filter(F.col("prefix") | (F.size("toks") != 1)).select("query_id", "pno")
        complex_n = (hits.join(F.broadcast(complex_keys), ["query_id", "pno"], "left_semi")
                     .groupBy("query_id", "pno").agg(F.count(F.lit(1)).alias("nhit")))
        nhit = nhit.unionByName(complex_n)
    raw = F.log((F.lit(float(n_docs)) - F.col("nhit") + 0.5) / (F.col("nhit") + 0.5))
    return nhit.select("query_id", "pno", F.when(raw <= 0, F.lit(IDF_FLOOR)).otherwise(raw).alias("idf"))


def score(index: FullTextIndex, queries: DataFrame) -> DataFrame:
    """(query_id, <keys>, score, matched) for every document satisfying its
    query; score is the negated BM25 sum (ascending = best)."""
    queries = query_side(queries)
    n_docs, avgdl = average_length(index.corpus)
    shape = batch_shape(queries)
    hits = phrase_hits(index, queries, shape)
    idf = F.broadcast(phrase_idf(index, queries, hits, n_docs, any(shape)))   # queries × phrases rows
    return _summed(index, queries, hits.join(idf, ["query_id", "pno"]), avgdl)


def _summed(index: FullTextIndex, queries: DataFrame, hits: DataFrame, avgdl: float) -> DataFrame:
    """Documents that satisfy their query, with the sum of their hits' weights."""
    contrib = F.col("idf") * weight(F.col("tf"), F.col("doc_len"), avgdl)
    per_doc = (hits.groupBy("query_id", *index.keys)
               .agg(F.collect_set("pno").alias("matched"), (-F.sum(contrib)).alias("score")))
    q = queries.select("query_id", "clauses")
    return (per_doc.join(q, "query_id")
            .filter(clause_match(F.col("matched"), F.col("clauses")))
            .drop("clauses"))


# --- early stop (X7, T1) ---------------------------------------------------------------------

#: Blocks of a query that give its first threshold.
FIRST_BLOCKS = 8
#: Postings of a batch's terms from which blocks are worth the extra steps.
EARLY_FROM = 20_000_000
#: (term, block) pairs that are pushed into the scan one by one.
PUSHED_CELLS = 512
TIE = 1e-8  # scores that round to the same 9 places are ties


def term_queries(queries: DataFrame) -> DataFrame:
    """Queries whose phrases are all single exact terms."""
    return queries.filter(F.forall("phrases", lambda p: ~p["prefix"] & (F.size(tokenize(p["text"])) == 1)))


def block_bounds(index: FullTextIndex, queries: DataFrame) -> DataFrame:
    """(query_id, block, terms, n, bound, place): per query and document block
    the terms with idf that have postings there, how many these are, what a
    document can score at most, and the block's place by that bound.  At most
    queries x blocks rows, whatever the corpus."""
    n_docs, avgdl = average_length(index.corpus)
    terms = batch_terms(queries)
    exact, _ = query_terms(index, query_side(queries), False)
    idf = phrase_idf(index, query_side(queries), None, n_docs, False)
    peaks = index.blocks.filter(among("term", terms)).groupBy("term", "block").agg(
        # a larger average length raises a weight by its factor at most
        F.sum("n").alias("n"), F.max(F.col("peak") * F.greatest(F.lit(1.0), F.lit(avgdl) / F.col("avgdl"))).alias("peak"))
    x = exact.select("query_id", "pno", "term").join(idf, ["query_id", "pno"]).join(peaks, "term")
    got = x.groupBy("query_id", "block").agg(
        F.collect_list(F.struct("pno", "term", "idf")).alias("terms"), F.sum("n").alias("n"),
        F.sum(F.col("idf") * F.col("peak")).alias("bound"))
    return got.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")))


def score_in(index: FullTextIndex, queries: DataFrame, cells: DataFrame) -> DataFrame:
    """``score`` of term queries over some blocks (rows of ``block_bounds``)."""
    _, avgdl = average_length(index.corpus)
    pairs = cells.select("query_id", "block", F.explode("terms").alias("t")).select("query_id", "block", "t.*")
    some = pairs.select("term", "block").distinct().limit(PUSHED_CELLS + 1).collect()
    postings = index.postings.filter(among("term", batch_terms(queries)))
    if len(some) <= PUSHED_CELLS:
        blocks: dict[str, list[int]] = {}
        for r in some:
            blocks.setdefault(r["term"], []).append(r["block"])
        each = [(F.col("term") == t) & F.col("block").isin(sorted(b)) for t, b in sorted(blocks.items())]
        postings = postings.filter(reduce(or_, each) if each else F.lit(False))
    hits = postings.select("term", "block", *index.keys, "tf", "doc_len").join(pairs, ["term", "block"])
    return _summed(index, query_side(queries), hits, avgdl)


def top_scores(index: FullTextIndex, queries: DataFrame, keep, order: list[Column], limit: Column | int,
               rank: str, most: int | None, early: bool | None = None) -> DataFrame:
    """The best ``limit`` rows per query of ``keep(scores)``.

    With ``early`` (by default when the terms of the batch have ``EARLY_FROM``
    postings) single-term queries look at their ``FIRST_BLOCKS`` most promising
    document blocks first; blocks whose bound is worse than the last row found
    are not looked at.  The rows are the same."""
    best = lambda df: top_k(keep(df), "query_id", order, limit, rank, most)
    if index.blocks is None:
        return best(score(index, queries))
    if early is None:
        terms = index.term_stats.filter(among("term", batch_terms(queries)))
        early = int(terms.agg(F.sum("df")).first()[0] or 0) >= EARLY_FROM
    if not early:
        return best(score(index, queries))
    plain = term_queries(queries)
    other = queries.join(plain.select("query_id"), "query_id", "left_anti")
    bounds = cut_lineage(block_bounds(index, plain))
    first = cut_lineage(best(score_in(index, plain, bounds.filter(F.col("place") <= FIRST_BLOCKS))))
    limits = queries.select("query_id", (F.lit(limit) if isinstance(limit, int) else F.col("lim")).alias("_lim"))
    last = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"), F.max("score").alias("_last")).join(
        limits, "query_id").filter(F.col("_n") >= F.col("_lim")).select("query_id", "_last")
    rest = bounds.filter(F.col("place") > FIRST_BLOCKS).join(last, "query_id", "left").filter(
        F.col("_last").isNull() | (-F.col("bound") <= F.col("_last") + TIE))
    rest = cut_lineage(rest.drop("_last"))
    rows = first.drop(rank).unionByName(best(score_in(index, plain, rest)).drop(rank))
    w = Window.partitionBy("query_id").orderBy(*order)
    rows = rows.withColumn(rank, F.row_number().over(w))
    rows = rows.filter(F.col(rank) <= (most if most is not None else limit)).filter(F.col(rank) <= limit)
    if other.isEmpty():
        return rows
    return rows.unionByName(best(score(index, other)).select(rows.columns))


def early_share(index: FullTextIndex, queries: DataFrame, limit: int) -> DataFrame:
    """(query_id, postings, looked_at): how many postings the terms of each
    single-term query have, and how many lie in blocks that an early stop at
    ``limit`` rows looks at."""
    plain = term_queries(queries)
    bounds = cut_lineage(block_bounds(index, plain))
    first = score_in(index, plain, bounds.filter(F.col("place") <= FIRST_BLOCKS))
    w = Window.partitionBy("query_id").orderBy("score")
    kth = first.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == limit).select("query_id", F.col("score").alias("_last"))
    x = bounds.join(kth, "query_id", "left")
    seen = (F.col("place") <= FIRST_BLOCKS) | F.col("_last").isNull() | (-F.col("bound") <= F.col("_last") + TIE)
    return x.groupBy("query_id").agg(F.sum("n").alias("postings"), F.sum(F.when(seen, F.col("n")).otherwise(0)).alias("looked_at"))


def session_filter(sessions_col_prefix: str = "") -> Column:
    """Optional per-query predicates (NULL filter = no predicate)."""
    p = F.col("project_filter")
    s = F.col("source_filter")
    n = F.col("node_filter")
    return ((p.isNull() | contains_ci(F.col("project"), p))
            & (s.isNull() | (F.col("source") == s))
            & (n.isNull() | (F.col("node") == n)))


def top_k(df: DataFrame, part: str, order: list[Column], limit_col: Column | int,
          rank_name: str = "rank", max_limit: int | None = None) -> DataFrame:
    """Per-group ORDER BY … LIMIT via row_number.

    The filter must compare with a literal for Spark to plan WindowGroupLimit
    (a partial top-k before the shuffle), so a per-row limit column is paired
    with the batch-wide maximum ``max_limit``."""
    w = Window.partitionBy(part).orderBy(*order)
    r = df.withColumn(rank_name, F.row_number().over(w))
    if isinstance(limit_col, int):
        return r.filter(F.col(rank_name) <= limit_col)
    if max_limit is not None:
        r = r.filter(F.col(rank_name) <= max_limit)
    return r.filter(F.col(rank_name) <= limit_col)


def max_limit(queries: DataFrame) -> int:
    """Largest per-query limit of a batch (one bounded scalar)."""
    return int(queries.agg(F.max("lim")).first()[0] or 0)


def search_sessions(index: FullTextIndex, queries: DataFrame, turns: DataFrame,
                    sessions: DataFrame, early: bool | None = None) -> DataFrame:
    """Ranked hits with session metadata for a batch of queries.

    Output: query_id, rank, session_id, turn_idx, ts, role, project, title, node,
    score (rounded to 6 places).
    """
    keys = list(index.keys)
    s = sessions.select("session_id", "project", "ai_title", "node", "source")
    q = query_side(queries.select("query_id", "lim", "project_filter", "source_filter", "node_filter"))
    ranked = top_scores(index, queries, lambda scored: scored.join(s, "session_id").join(q, "query_id").filter(session_filter()),
                        [F.round("score", 9), F.col("session_id"), F.col("turn_idx")], F.col("lim"), "rank",
                        max_limit(queries), early)
    t = turns.select(*keys, "ts", "role", "text")
    out = ranked.join(t, keys)
    return out.select(
        "query_id", F.col("rank").cast("int").alias("rank"), *keys,
        display_ts(F.col("ts")).alias("ts"), "role", "project",
        F.coalesce("ai_title", F.lit("(no title)")).alias("title"),
        F.coalesce("node", F.lit("local")).alias("node"),
        F.round("score", 6).alias("score"), "text", "matched")


def seeds(index: FullTextIndex, queries: DataFrame, seed_limit_col: Column | int) -> DataFrame:
    """Top seed documents per query (no session filters), for thread recall."""
    keys = list(index.keys)
    most = seed_limit_col if isinstance(seed_limit_col, int) else None
    got = top_scores(index, queries, lambda scored: scored, [F.round("score", 9), *[F.col(k) for k in keys]],
                     seed_limit_col, "seed_rank", most)
    return got.select("query_id", *keys, "seed_rank", "score")
