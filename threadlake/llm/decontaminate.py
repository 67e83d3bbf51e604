"""Benchmark decontamination, DataFrame functions only.

An item leaks into a document when the document holds at least ``threshold`` of
the item's distinct 5-word shingles (containment, not Jaccard: items are short,
documents may be very long).

1. Items are partitioned by size (number of shingles, powers of two).  An
   item's MinHash sketch is its k smallest shingle hashes, with k one more than
   the number of shingles a leaking document may lack at the upper size of the
   partition.  So at least one sketch hash is in every leaking document: the
   search has recall 1, while banding on Jaccard would need more and more
   hashes the longer the document.
2. Every shingle of every document is hashed and looked up in the sketches.
   Documents too small for an item's partition are left out by their size.
3. Each candidate pair is verified by the exact shingles, as strings.

Words are lower-cased.  Items of 1 to 4 words have one shingle, the whole item,
and their sketch is matched against document shingles of that length.

Defined cases: null or empty texts and items have no shingle and match nothing;
equal items (and repeated rows) each match; null ids are kept as ids; rows that
share a doc_id, or have none, are told apart by 128 bits of their text; other
columns may have any name; very long texts are searched whole; an empty table gives
no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import GAP, fingerprint, packed, stored

WIDTH = 5
THRESHOLD = 0.8
#: Sketch rows that are broadcast at most (24 bytes each); beyond, shuffled.
BROADCAST_ROWS = 500_000
#: What tells the rows of documents apart.
ROW = ("doc_id", "_f1", "_f2")


def words(text: Column) -> Column:
    """Lower-cased words; no empty strings."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def shingles(w: Column, width: int = WIDTH) -> Column:
    """Every run of ``width`` words as one string (spaces between)."""
    n = F.size(w) - (width - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                     lambda i: F.array_join(F.slice(w, i, width), " "))
                  ).otherwise(F.array().cast("array<string>"))


def shingle_hashes(w: Column, width: int = WIDTH) -> Column:
    """Hashes of the runs.  The words are hashed apart, so that no string is
    built for the documents' many shingles."""
    n = F.size(w) - (width - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                                     lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)]))
                  ).otherwise(F.array().cast("array<bigint>"))


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """benchmark(item_id, text) → item_id, width, shingles (distinct), n_item."""
    w = words(F.col("text"))
    b = benchmark.select("item_id", w.alias("w")).filter(F.size("w") > 0)
    b = b.withColumn("width", F.least(F.size("w"), F.lit(WIDTH)))
    full = F.array_distinct(shingles(F.col("w")))
    b = b.withColumn("shingles", F.when(F.col("width") == WIDTH, full)
                     .otherwise(F.array(F.array_join("w", " "))))
    return b.withColumn("n_item", F.size("shingles")).drop("w")


def sketches(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """items → item_id, width, h: the bottom-k MinHash sketch, k by partition."""
    part = F.floor(F.log2(F.col("n_item")))  # sizes 2^part .. 2^(part+1)-1
    top = F.pow(F.lit(2.0), part + 1) - 1
    k = (top - F.ceil(top * F.lit(threshold) - 1e-9) + 1).cast("int")
    return items.withColumn("k", k).withColumn("low", F.pow(F.lit(2.0), part)).select(
        "item_id", "width", "low", F.explode(F.slice(F.array_sort(F.transform(
            "shingles", lambda s: F.xxhash64(*[F.get(F.split(s, " "), F.lit(j)) for j in range(WIDTH)]))),
            1, F.greatest(F.col("k"), F.lit(1)))).alias("h"))


def search(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Candidate pairs (row: doc_id and fingerprint, item_id), each once."""
    sketch = stored(sketches(items, threshold), "sketches")
    widths = [r[0] for r in sketch.select("width").distinct().collect()]  # at most WIDTH values
    small = sketch.count() <= BROADCAST_ROWS
    w = docs.select(*ROW, words(F.col("text")).alias("w"))
    found = []
    for width in sorted(widths):
        # a shorter run fills the missing words with null, as the sketch does
        hashes = shingle_hashes(F.col("w"), width) if width == WIDTH else F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0))), lambda i: F.xxhash64(
                *[F.get(F.col("w"), i + j) if j < width else F.lit(None).cast("string") for j in range(WIDTH)]))
        d = w.select(*ROW, F.size("w").alias("n"), F.explode(hashes).alias("h"))
        s = sketch.filter(F.col("width") == width).drop("width")
        if not small:
            d = d.distinct()
        # n - width + 1 shingles at most; a leaking document has threshold * item of them
        found.append(d.join(F.broadcast(s) if small else s, "h")
                     .filter(F.col("n") - (width - 1) >= F.col("low") * F.lit(threshold) - 1e-9)
                     .select(*ROW, "item_id"))
    if not found:
        none = F.lit(None).cast(dict(items.dtypes)["item_id"])
        return docs.select(*ROW, none.alias("item_id")).filter(F.lit(False))
    return reduce(DataFrame.unionByName, found).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs(doc_id, text), benchmark(item_id, text) → doc_id, item_id, n_item,
    n_shared, containment of every pair at or above ``threshold``.

    Rows of one doc_id, and items of one item_id, are judged row by row; the
    best pair of rows counts.
    """
    return (row_leaks(docs, benchmark, threshold).groupBy("doc_id", "item_id").agg(F.max("_pair").alias("_best"))
            .select("doc_id", "item_id", "_best.n_item", "_best.n_shared", "_best.containment"))


def named(docs: DataFrame) -> DataFrame:
    """docs plus the fingerprint of the text."""
    return docs.withColumns(dict(zip(ROW[1:], fingerprint(F.col("text")), strict=True)))


def row_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The leaks of every row of docs: ROW, item_id, _pair (containment,
    n_item, n_shared)."""
    items = item_shingles(benchmark.select("item_id", "text"))
    docs = named(docs.select("doc_id", "text"))
    pairs = stored(search(docs, items, threshold), "leak-candidates")
    d = docs.filter(F.col("text").isNotNull()).select(*[F.col(c).alias(f"_d{c}") for c in ROW], "text")
    i = items.select(F.col("item_id").alias("_i"), "width", "shingles", "n_item")
    # pairs per row first: the text of a row meets its items once
    per_row = pairs.groupBy(*ROW).agg(F.collect_set(F.struct("item_id")).alias("_items"))
    same = reduce(Column.__and__, [F.col(f"_d{c}").eqNullSafe(F.col(c)) for c in ROW])
    both = (d.join(per_row, same).withColumn("w", words(F.col("text")))
            .select(*ROW, F.array_distinct(shingles(F.col("w"))).alias("_s"), "w",
                    F.explode("_items").alias("_item")).withColumn("item_id", F.col("_item.item_id"))
            .join(i, F.col("item_id").eqNullSafe(F.col("_i"))))
    short = F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" "))
    n = (F.when(F.col("width") == WIDTH, F.size(F.array_intersect("_s", "shingles")))
         .otherwise(F.contains(short, F.concat(F.lit(" "), F.col("shingles")[0], F.lit(" "))).cast("int")))
    share = F.col("n_shared") / F.col("n_item")
    return (both.withColumn("n_shared", n.cast("long")).withColumn("n_item", F.col("n_item").cast("long"))
            .filter(F.col("n_shared") >= F.ceil(F.col("n_item") * F.lit(threshold) - 1e-9))
            .select(*ROW, "item_id", F.struct(share.alias("containment"), "n_item", "n_shared").alias("_pair")))


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without a leak, judged row by row."""
    bad = stored(row_leaks(docs, benchmark, threshold).select(*[F.col(c).alias(f"_bad{c}") for c in ROW]).distinct(),
                 "leaking")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_bad{c}")) for c in ROW])
    rows = packed(docs, "doc_id", *[f.alias(n) for n, f in zip(ROW[1:], fingerprint(F.col("text")), strict=True)])
    return rows.join(bad, same, "left_anti").select("doc.*")
