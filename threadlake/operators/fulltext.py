"""Full-text index: tokenizer output, postings, term and corpus statistics.

Tables (``bucket`` is a generation, ``g0``, ``g1``, ...; layout and pointer of
``sources/store.py``):

* ``postings(term, <doc keys>, tf, positions ARRAY<INT>, doc_len)`` sorted by term
* ``gone(session_id)``: sessions whose postings of older generations are dead
* ``term_stats(term, df, cf)``, ``corpus(n_docs, total_len)``: signed, the sum
  over the generations counts
* ``block_max(term, block, n, peak, avgdl)``: postings and their highest BM25
  weight (without idf, at the ``avgdl`` of the generation) per document block
* ``text_sums(dr, n, h)``, ``posting_sums(dr, tr, n, h)``: signed, order-free
  checksums per document range and per (document range, term range)

A build (S12) writes one generation.  ``FullTextIndex.update`` adds one for
changed sessions: their new postings, their keys in ``gone``, and the difference
of all sums, worked out from their old and new turns alone; nothing older is
read or rewritten.  ``compact`` folds the generations into one.  The integrity
check (S13) compares checksums and retokenizes only documents of ranges that
differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.functions.indexing import spread
from threadlake.functions.text import tokenize
from threadlake.session import cut_lineage
from threadlake.sources import store

DOC_KEYS = ["session_id", "turn_idx"]
TERM_BUCKETS = 64
#: Ranges (by hash) of the checksums: documents, terms.
DOC_RANGES, TERM_RANGES = 1024, 64
TABLES = ("postings", "gone", "term_stats", "corpus", "block_max", "text_sums", "posting_sums")


def tokens(docs: DataFrame, keys: list[str] = DOC_KEYS, text_col: str = "text") -> DataFrame:
    """One row per token occurrence: (<keys>, pos, token)."""
    # posexplode_outer: a plain posexplode makes the optimizer infer a
    # size(tokens) > 0 filter and push that tokenization below the repartition
    t = spread(docs.select(*keys, text_col), keys).select(
        *keys, F.posexplode_outer(tokenize(F.col(text_col))).alias("pos", "token"))
    return t.filter(F.col("token").isNotNull())


def build_postings(docs: DataFrame, keys: list[str] = DOC_KEYS, text_col: str = "text") -> DataFrame:
    """Inverted index with positions.

    The postings of a row are made from its sorted tokens, inside the row: no
    shuffle by term.  Rows with the same keys are one document: where there are
    such rows (a count of the keys alone, run at once), their postings are merged.
    """
    out = _row_postings(spread(docs.select(*keys, F.col(text_col).alias("_text")), keys), keys)
    if not docs.groupBy(*keys).count().filter("count > 1").isEmpty():
        out = out.groupBy("term", *keys).agg(
            F.sum("tf").cast("int").alias("tf"), F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions"),
            F.first("doc_len").alias("doc_len"))
    return out.withColumns({"term_bucket": term_bucket(F.col("term")), "block": doc_block(F.col(keys[0]), F.col("doc_len"))})


def _row_postings(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Postings of each row (<keys>, _text) by itself: its (token, position) pairs
    are sorted, and every run of a token is a posting."""
    split = rows.select(*keys, tokenize(F.col("_text")).alias("_toks"))
    pairs = split.select(*keys, F.size("_toks").alias("doc_len"), F.array_sort(F.transform(
        "_toks", lambda t, i: F.struct(t.alias("term"), i.alias("pos")))).alias("_pairs"))
    begins = F.filter(F.transform("_pairs", lambda p, i: F.when(
        (i == 0) | (F.get("_pairs", i - 1)["term"] != p["term"]), i)), lambda i: i.isNotNull())
    pairs = pairs.withColumn("_begins", begins)
    ends = lambda i: F.coalesce(F.get("_begins", i + 1), F.size("_pairs"))
    runs = F.transform("_begins", lambda b, i: F.struct(F.get("_pairs", b)["term"].alias("term"), F.transform(
        F.slice("_pairs", b + 1, ends(i) - b), lambda p: p["pos"]).alias("positions")))
    out = pairs.select(*keys, "doc_len", F.explode(runs).alias("_run"))
    return out.select("_run.term", *keys, F.size("_run.positions").alias("tf"), "_run.positions", "doc_len")


def term_bucket(term) -> F.Column:
    """Hash class of a term."""
    return F.pmod(F.xxhash64(term), F.lit(TERM_BUCKETS)).cast("int")


#: Hash blocks of a class of document lengths; a factor of 2 spans ``LENGTHS`` classes.
BLOCK_SPLITS, LENGTHS = 16, 2
# Fixed BM25 constants (Okapi defaults used by FTS5).
K1 = 1.2
B = 0.75


def doc_block(key: F.Column, doc_len: F.Column) -> F.Column:
    """Block of a document: documents of like length (which weigh alike), split
    by a hash.  All postings of a document are in one block; there are some
    hundred blocks, however many documents."""
    return (F.floor(F.log2(doc_len + 1) * LENGTHS) * BLOCK_SPLITS + F.pmod(F.xxhash64(key), F.lit(BLOCK_SPLITS))).cast("int")


def weight(tf: F.Column, doc_len: F.Column, avgdl: float) -> F.Column:
    """BM25 weight of a posting without idf."""
    norm = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * doc_len / F.lit(avgdl if avgdl else 1.0))
    return (tf * (K1 + 1)) / (tf + norm)


def average_length(corpus: DataFrame) -> tuple[int, float]:
    """(number of documents, their average length): two scalars of one row."""
    row = corpus.first()
    n = int(row["n_docs"] or 0)
    return n, (float(row["total_len"]) / n) if n else 0.0


def block_max(postings: DataFrame, avgdl: float) -> DataFrame:
    return postings.groupBy("term", "block").agg(
        F.count(F.lit(1)).alias("n"), F.max(weight(F.col("tf"), F.col("doc_len"), avgdl)).alias("peak")).withColumn(
        "avgdl", F.lit(float(avgdl)))


def doc_lengths(docs: DataFrame, keys: list[str] = DOC_KEYS, text_col: str = "text") -> DataFrame:
    return spread(docs.select(*keys, text_col), keys).select(*keys, F.size(tokenize(F.col(text_col))).cast("int").alias("doc_len"))


def term_stats(postings: DataFrame) -> DataFrame:
    """(term, df, cf) — partial aggregation keeps hot terms cheap."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def corpus_stats(docs_len: DataFrame) -> DataFrame:
    """(n_docs, total_len) over every document, including token-less ones."""
    return docs_len.agg(F.count(F.lit(1)).alias("n_docs"),
                        F.coalesce(F.sum("doc_len"), F.lit(0)).cast("long").alias("total_len"))


def corpus_from_postings(docs: DataFrame, postings: DataFrame) -> DataFrame:
    """Same as ``corpus_stats`` without a second tokenisation: the document
    count comes from the documents, the total length is Σ tf."""
    from threadlake.operators.sessions import one_row_join
    n = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    tot = postings.agg(F.coalesce(F.sum("tf"), F.lit(0)).cast("long").alias("total_len"))
    return one_row_join([n, tot])


# --- checksums -------------------------------------------------------------------------------

def doc_range(key) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(DOC_RANGES)).cast("int")


def _sum_of(*cols) -> list[F.Column]:
    """Rows and order-free sum of their 64-bit hashes."""
    h = F.xxhash64(*cols)  # in halves: sums of longs, put together once per group
    halves = [F.sum(x).cast("decimal(28,0)") for x in (F.shiftright(h, 32), h.bitwiseAND(0xFFFFFFFF))]
    return [F.count(F.lit(1)).alias("n"), (halves[0] * F.lit(2 ** 32).cast("decimal(10,0)") + halves[1]).cast("decimal(30,0)").alias("h")]


def text_sums(docs: DataFrame, keys: list[str] = DOC_KEYS, text_col: str = "text") -> DataFrame:
    """(dr, n, h) of the source texts; nothing is tokenized."""
    return docs.groupBy(doc_range(keys[0]).alias("dr")).agg(*_sum_of(*keys, text_col))


def posting_sums(postings: DataFrame, keys: list[str] = DOC_KEYS) -> DataFrame:
    """(dr, tr, n, h) of postings."""
    tr = F.pmod(F.xxhash64("term"), F.lit(TERM_RANGES)).cast("int")
    return postings.groupBy(doc_range(keys[0]).alias("dr"), tr.alias("tr")).agg(*_sum_of("term", *keys, "tf", "positions"))


def signed(new: DataFrame, old: DataFrame, by: list[str]) -> DataFrame:
    """new - old of all number columns per ``by``, rows of zeros left out."""
    values = [c for c in new.columns if c not in by]
    kinds = {f.name: f.dataType for f in new.schema}
    less = old.select(*by, *[(-F.col(c)).alias(c) for c in values])
    both = new.select(*by, *values).unionByName(less)
    out = both.groupBy(*by).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in values])
    return out.filter(" or ".join(f"{c} != 0" for c in values))


def _added_up(df: DataFrame, by: list[str], values: list[str], alive: str) -> DataFrame:
    """Signed rows of several generations added up; ``alive`` tells what counts."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.groupBy(*by).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in values]).filter(alive)


@dataclass
class FullTextIndex:
    postings: DataFrame
    term_stats: DataFrame
    corpus: DataFrame
    keys: tuple[str, ...] = tuple(DOC_KEYS)
    docs: DataFrame | None = None
    path: str | None = None
    blocks: DataFrame | None = None

    @classmethod
    def build(cls, docs: DataFrame, keys: list[str] = DOC_KEYS, text_col: str = "text") -> "FullTextIndex":
        """(re)build the whole index from the documents."""
        p = build_postings(docs, keys, text_col)
        return cls(p, term_stats(p), corpus_from_postings(docs, p), tuple(keys), docs)

    def write(self, path: str) -> None:
        """One generation that replaces what is under ``path``.  Postings
        are range-partitioned and sorted by (term, keys): a pushed term filter
        skips row groups, a hot term spans tasks and files, and the number of
        tasks follows the volume.  They are computed once; all sums are derived
        from the written ones."""
        spark, keys = self.postings.sparkSession, list(self.keys)
        gen = lambda df: df.withColumn("bucket", F.lit("g0"))
        order = {"postings": ["term", "block", *keys], "block_max": ["term", "block"], "term_stats": ["term"]}
        # sorting by range reads its input twice (once for the bounds): the texts are tokenized once
        with store.kept(self.postings.drop("term_bucket"), path) as made:
            number = store.publish(spark, path, {"postings": gen(made)}, order)
        written = store.read(spark, path, "postings").drop("bucket")
        gone = written.select(keys[0]).limit(0)
        corpus = cut_lineage(corpus_from_postings(self.docs, written) if self.docs is not None else self.corpus)
        rest = {"gone": gone, "term_stats": term_stats(written), "corpus": corpus,
                "block_max": block_max(written, average_length(corpus)[1]),
                "text_sums": text_sums(self.docs, keys) if self.docs is not None else
                text_sums(written.select(*keys, F.lit("").alias("text")).limit(0), keys),
                "posting_sums": posting_sums(written, keys)}
        store.publish(spark, path, {t: gen(df) for t, df in rest.items()}, order)
        if number:  # a rebuild: what it replaces may go
            store.retire(spark, path, keep=1)

    @classmethod
    def read(cls, spark, path: str, keys: list[str] = DOC_KEYS) -> "FullTextIndex":
        """The index as of its newest generation."""
        now = {t: store.read(spark, path, t) for t in TABLES}
        generations = {b.bucket for b in store.pointer(spark, path)[1]} - {""}
        postings, stats, corpus = now["postings"], now["term_stats"], now["corpus"]
        if len(generations) > 1:
            number = F.substring("bucket", 2, 20).cast("int")
            dead = now["gone"].groupBy(F.col(keys[0]).alias("_gone")).agg(F.max(number).alias("_from"))
            live = postings.withColumn("_gen", number)
            postings = live.join(dead, (F.col(keys[0]) == F.col("_gone")) & (F.col("_gen") < F.col("_from")),
                                 "left_anti").drop("_gen")
            stats = _added_up(stats, ["term"], ["df", "cf"], "df > 0")
            corpus = corpus.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n_docs", "total_len")])
        postings = postings.drop("bucket").withColumn("term_bucket", term_bucket(F.col("term")))
        return cls(postings, stats.drop("bucket"), corpus.drop("bucket"), tuple(keys), None, path,
                   now["block_max"].drop("bucket"))

    @classmethod
    def update(cls, spark, path: str, changed: DataFrame, old_docs: DataFrame, new_docs: DataFrame,
               keys: list[str] = DOC_KEYS) -> int:
        """A generation for the ``changed`` sessions: ``old_docs`` are their
        documents as indexed so far, ``new_docs`` as they are now (either may
        lack some).  Work and bytes written follow these documents.  Returns the
        number of the generation."""
        gen = 1 + max(int(b.bucket[1:]) for b in store.pointer(spark, path)[1] if b.bucket)
        keep = changed.select(keys[0]).distinct()
        old = cut_lineage(old_docs.join(keep, keys[0], "left_semi"))
        new = cut_lineage(new_docs.join(keep, keys[0], "left_semi"))
        old_p, new_p = (cut_lineage(build_postings(d, keys).drop("term_bucket")) for d in (old, new))
        avgdl = average_length(cls.read(spark, path, keys).corpus)[1]
        tables = {"postings": new_p, "gone": keep, "block_max": block_max(new_p, avgdl),
                  "term_stats": signed(term_stats(new_p), term_stats(old_p), ["term"]),
                  "corpus": signed(corpus_from_postings(new, new_p), corpus_from_postings(old, old_p), []),
                  "text_sums": signed(text_sums(new, keys), text_sums(old, keys), ["dr"]),
                  "posting_sums": signed(posting_sums(new_p, keys), posting_sums(old_p, keys), ["dr", "tr"])}
        tables = {t: df.withColumn("bucket", F.lit(f"g{gen}")) for t, df in tables.items()}
        order = {"postings": ["term", "block", *keys], "block_max": ["term", "block"], "term_stats": ["term"]}
        store.publish(spark, path, tables, order, {f"g{gen}"})
        return gen

    @classmethod
    def compact(cls, spark, path: str, keys: list[str] = DOC_KEYS) -> None:
        """Fold all generations into one (S12 without tokenizing anything)."""
        index = cls.read(spark, path, keys)
        sums = stored_sums(spark, path)
        tables = {"postings": index.postings.drop("term_bucket"), "gone": index.postings.select(keys[0]).limit(0),
                  "term_stats": index.term_stats, "corpus": index.corpus, "text_sums": sums[0], "posting_sums": sums[1],
                  "block_max": block_max(index.postings, average_length(index.corpus)[1])}
        store.publish(spark, path, {t: df.withColumn("bucket", F.lit("g0")) for t, df in tables.items()},
                      {"postings": ["term", "block", *keys], "block_max": ["term", "block"], "term_stats": ["term"]})
        store.retire(spark, path, keep=1)


def stored_sums(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """(text sums, posting sums) over all generations."""
    return (_added_up(store.read(spark, path, "text_sums"), ["dr"], ["n", "h"], "n != 0 or h != 0"),
            _added_up(store.read(spark, path, "posting_sums"), ["dr", "tr"], ["n", "h"], "n != 0 or h != 0"))


def unequal(have: DataFrame, want: DataFrame, by: list[str]) -> DataFrame:
    """``by`` of the checksums that differ or are missing on one side."""
    both = have.unionByName(want.select(*by, (-F.col("n")).alias("n"), (-F.col("h")).alias("h")))
    return both.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("h").alias("h")).filter("n != 0 or h != 0").select(*by)


def suspect_docs(spark, path: str, docs: DataFrame, keys: list[str] = DOC_KEYS) -> DataFrame:
    """S13, first step: (dr, tr) ranges to look into, at most DOC_RANGES x
    TERM_RANGES rows.  A text that differs from what was indexed makes all term
    ranges of its document range suspect, a posting that differs from what was
    written only its own."""
    texts, postings = stored_sums(spark, path)
    index = FullTextIndex.read(spark, path, keys)
    by_text = unequal(text_sums(docs, keys), texts, ["dr"])
    by_posting = unequal(posting_sums(index.postings, keys), postings, ["dr", "tr"])
    all_terms = by_text.select("dr", F.explode(F.sequence(F.lit(0), F.lit(TERM_RANGES - 1))).alias("tr"))
    return all_terms.unionByName(by_posting).distinct()


def check_index(spark, path: str, docs: DataFrame, keys: list[str] = DOC_KEYS) -> DataFrame:
    """Rows of the stored postings that differ from a recompute, as
    ``integrity_check`` gives them; only documents in suspect ranges are
    tokenized."""
    ranges = cut_lineage(suspect_docs(spark, path, docs, keys))
    index = FullTextIndex.read(spark, path, keys)
    dr, tr = doc_range(keys[0]).alias("dr"), F.pmod(F.xxhash64("term"), F.lit(TERM_RANGES)).cast("int").alias("tr")
    # the ranges are bounded by the two constants
    some = docs.withColumn("dr", dr).join(F.broadcast(ranges.select("dr").distinct()), "dr", "left_semi").drop("dr")
    cut = lambda p: p.withColumns({"dr": dr, "tr": tr}).join(F.broadcast(ranges), ["dr", "tr"], "left_semi")
    return _differences(cut(index.postings), cut(build_postings(some, keys)), keys)


def integrity_check(stored: DataFrame, docs: DataFrame, keys: list[str] = DOC_KEYS,
                    text_col: str = "text") -> DataFrame:
    """S13 for postings without checksums: rows that differ from a recompute.

    Returns (side, term, <keys>, tf) where side is ``stale`` (only in the stored
    index) or ``missing`` (only in the recomputed one).  Empty = consistent.
    """
    return _differences(stored, build_postings(docs, keys, text_col), keys)


def _differences(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    cols = ["term", *keys, "tf", F.array_join("positions", ",").alias("positions")]   # bucket is derived
    old, new = stored.select(*cols), fresh.select(*cols)
    return (old.exceptAll(new).withColumn("side", F.lit("stale"))
            .unionByName(new.exceptAll(old).withColumn("side", F.lit("missing"))))
