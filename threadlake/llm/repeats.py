"""Substring dedup: words covered by a word window that occurs more than once.

A window is ``WINDOW`` (35) consecutive words of one document.  Its repeats are
found level by level, doubling the length:

level 9    In every stretch of 27 neighbouring 9-word windows the one with the
           least hash is an anchor.  Equal 35-word windows hold equal 9-word
           windows, so they agree on their anchor, and only anchors (about one
           window in 14) are counted.  An anchor seen once can lie in no
           repeated 35-word window.
level 18   Anchors that repeat are extended to 18 words, to the right and to
           the left.  A 35-word window around an anchor holds one of the two.
level 35   Windows around surviving 18-word windows are counted in full, with
           96-bit hashes.  What repeats there is the answer.

Window counts are map-side combined sums by hash, joined back by hash, so a
passage that a third of all documents share is never gathered anywhere.  Texts
are hashed where they lie (Arrow batches in, narrow rows out).

Defined cases: null text has no words; texts under 35 words are left whole;
equal texts remove each other; rows with equal doc_id are told apart by a
fingerprint of the text (equal rows give equal results); an empty table gives
no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import discard, ready, stored

WINDOW = 35
SHORT = 9  # first level; the second is twice that, the third is capped at WINDOW
SPAN = WINDOW - SHORT + 1
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # multipliers of the two hashes


class _Hashes(dict):
    """Word → 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 2_000_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(words: list[bytes], known: _Hashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def windows(h: np.ndarray, width: int, odd: np.uint64 = ODD[0]) -> np.ndarray:
    """Hash of every run of ``width`` words, by doubling: a run of 2n words is
    the run of the first n times odd^n plus the run of the next n."""
    out, size, power, done = None, 1, odd, 0
    part = h  # runs of `size` words
    with np.errstate(over="ignore"):
        while True:
            if width & size:
                # what is done so far comes first, then this part
                if out is None:
                    out, done = part, size
                else:
                    n = len(h) - done - size + 1
                    out, done = out[:n] * power + part[done:done + n], done + size
            if size * 2 > width:
                break
            n = len(h) - 2 * size + 1
            part = part[:n] * power + part[size:size + n]
            power, size = power * power, size * 2
        return out ^ (out >> np.uint64(29))


def anchors(h9: np.ndarray) -> np.ndarray:
    """Positions that have the least hash (the first such) in some stretch of
    SPAN neighbouring windows."""
    mixed = h9 * np.uint64(0xD6E8FEB86659FD93)
    view = np.lib.stride_tricks.sliding_window_view(mixed, SPAN)
    return np.unique(view.argmin(1) + np.arange(len(view)))


def _sides(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 18-word windows that begin with, and that end with, the
    9-word window at ``at``; 0 where the text ends before."""
    h18 = windows(h, 2 * SHORT)
    right, left = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    ok = at < len(h18)
    right[ok] = h18[at[ok]]
    ok = at >= SHORT
    left[ok] = h18[at[ok] - SHORT]
    return right, left


def _texts(batches: Iterator[pa.RecordBatch], *more: str):
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("doc_id", "text", *more)]
        for row in zip(*cols, strict=True):
            yield row


def _flush(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    arrays = []
    for c, f in zip(cols, schema, strict=True):
        whole = np.concatenate(c) if isinstance(c[0], np.ndarray) else c
        arrays.append(pa.array(whole, f.type))
    rows.clear()
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _narrow(rows_of, columns: list[tuple[str, pa.DataType]], *more: str):
    """mapInArrow function: rows_of(row, known) gives arrays of equal length per
    document; they are put out in batches of bounded size."""
    schema = pa.schema(columns)

    def run(batches):
        known, held, n = _Hashes(), [], 0
        for row in _texts(batches, "fp", *more):
            got = rows_of(row, known)
            if got is not None and len(got[0]):
                held.append(got)
                n += len(got[0])
            if n > 200_000:
                yield _flush(held, schema)
                n = 0
        if held:
            yield _flush(held, schema)

    return run


def _as_long(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _level_9(row, known):
    doc_id, text, fp = row
    words = (text or "").encode().split()
    if len(words) < WINDOW:
        return None
    h = word_hashes(words, known)
    h9 = windows(h, SHORT)
    at = anchors(h9)
    right, left = _sides(h, at)
    n = len(at)
    return (np.full(n, fp), at.astype(np.int32), _as_long(h9[at]), _as_long(right), _as_long(left))


def _starts(at: np.ndarray, side: np.ndarray, n_words: int) -> np.ndarray:
    """Starts of the 35-word windows that hold the surviving 18-word windows:
    side 0 begins at the anchor, side 1 nine words before it."""
    first = np.where(side == 0, at, at - SHORT)
    mark = np.zeros(n_words + 1, np.int32)
    np.add.at(mark, np.clip(first - (WINDOW - 2 * SHORT), 0, n_words), 1)
    np.add.at(mark, np.clip(first + 1, 0, n_words), -1)
    ok = np.cumsum(mark)[:max(0, n_words - WINDOW + 1)] > 0
    return np.flatnonzero(ok)


CHUNK = 1_000_000  # windows of one task that are compared at once


def _level_35(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate windows as (fp, start, h1, h2).  Windows that are equal inside
    a chunk are known to repeat: one of them keeps its hashes, for windows
    elsewhere, the others go out without.  So no hash has more rows than chunks."""
    schema = pa.schema([("fp", pa.int64()), ("start", pa.int32()), ("h1", pa.int64()), ("h2", pa.int32()),
                        ("known", pa.bool_())])
    known, held, n = _Hashes(), [], 0

    def chunk() -> pa.RecordBatch:
        fp, start, one, two = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((two, one))
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        again, first = np.zeros(len(order), bool), np.ones(len(order), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        first[order[1:]] = ~same
        return pa.RecordBatch.from_arrays([
            pa.array(fp), pa.array(start), pa.array(one, mask=~first), pa.array(two, mask=~first), pa.array(again)],
            schema=schema)

    for _, text, fp, at, side in _texts(batches, "fp", "at", "side"):
        words = (text or "").encode().split()
        h = word_hashes(words, known)
        start = _starts(np.array(at), np.array(side), len(words))
        if len(start):
            two = windows(h, WINDOW, ODD[1])[start]
            held.append((np.full(len(start), fp), start.astype(np.int32), _as_long(windows(h, WINDOW)[start]),
                         (two >> np.uint64(32)).astype(np.uint32).view(np.int32)))
            n += len(start)
        if n > CHUNK:
            yield chunk()
            held, n = [], 0
    if held:
        yield chunk()


def _twice(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows whose key occurs more than once.  Counting combines before the
    shuffle.  The repeated keys are written first: then both sides of the join
    back are plain shuffles, and Spark splits a partition that one key fills."""
    often = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return rows.join(stored(often, name), keys, "left_semi")


def prepared(docs: DataFrame) -> DataFrame:
    """doc_id, text, fp: the fingerprint names a row in all later steps."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("fp"))


def candidates(docs: DataFrame) -> DataFrame:
    """prepared docs → fp, at, side (arrays): anchors whose 18-word windows
    occur more than once."""
    long, integer = pa.int64(), pa.int32()
    nine = docs.mapInArrow(
        _narrow(_level_9, [("fp", long), ("at", integer), ("h", long), ("right", long), ("left", long)]),
        "fp long, at int, h long, right long, left long")
    nine = stored(nine, "windows9")
    eighteen = stored(_twice(nine, ["h"], "repeated9").select(
        "fp", "at", F.posexplode(F.array("right", "left")).alias("side", "h")).filter("h != 0"), "windows18")
    discard(nine)
    return _twice(eighteen, ["side", "h"], "repeated18").groupBy("fp").agg(
        F.collect_list("at").alias("at"), F.collect_list("side").alias("side"))


def repeated_windows(texts: DataFrame) -> DataFrame:
    """texts(doc_id, text, fp, at, side) → fp, start of every 35-word window
    that occurs more than once in them."""
    full = stored(texts.mapInArrow(_level_35, "fp long, start int, h1 long, h2 int, known boolean"), "windows35")
    counted = full.filter("h1 IS NOT NULL")
    often = counted.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    elsewhere = counted.filter("NOT known").join(stored(often, "repeated35"), ["h1", "h2"], "left_semi")
    return full.filter("known").select("fp", "start").unionByName(elsewhere.select("fp", "start"))


def _own(batches):
    """doc_id, fp, n_words, digest of the whole word sequence, kept digest if
    nothing is removed."""
    for b in batches:
        ids, fps, n, whole = [], [], [], []
        for doc_id, text, fp in _texts([b], "fp"):
            words = (text or "").encode().split()
            ids.append(doc_id)
            fps.append(fp)
            n.append(len(words))
            whole.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(fps, pa.int64()), pa.array(n, pa.int64()), pa.array(whole, pa.string())],
            names=["doc_id", "fp", "n_words", "sha"])


def _cut(batches):
    """Texts with the starts of their repeated windows → what is left."""
    for b in batches:
        out = {"fp": [], "n_removed": [], "kept": []}
        for _, text, fp, starts in _texts([b], "fp", "starts"):
            words = text.encode().split()
            mark = np.zeros(len(words) + 1, np.int32)
            s = np.array(starts)
            np.add.at(mark, s, 1)
            np.add.at(mark, s + WINDOW, -1)
            gone = np.cumsum(mark)[:-1] > 0
            out["fp"].append(fp)
            out["n_removed"].append(int(gone.sum()))
            out["kept"].append(b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode())
        yield pa.RecordBatch.from_pandas(pd.DataFrame(out), schema=pa.schema(
            [("fp", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]), preserve_index=False)


def kept_words(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) → doc_id, fp, n_words, n_removed, sha of the whole
    text's words, kept (text that is left, null if all of it is).

    Word sequences that occur in several rows lose every word if they reach one
    window; one row of each stands for them in the window search.
    """
    ready(docs.sparkSession)
    d = prepared(docs)
    id_type = dict(docs.dtypes)["doc_id"]
    own = stored(d.mapInArrow(_own, f"doc_id {id_type}, fp long, n_words long, sha string"), "own-words")
    same = own.groupBy("sha").agg(F.count(F.lit(1)).alias("_copies"), F.min("fp").alias("_first"))
    copies = same.filter("_copies > 1").select(F.col("sha").alias("_sha"), "_first")
    copied = own.filter(F.col("n_words") >= WINDOW).join(copies, F.col("sha") == F.col("_sha"))
    # copies but the first need no search of their own
    skip = copied.filter(F.col("fp") != F.col("_first")).select("fp").distinct()
    found = candidates(d).join(skip, "fp", "left_anti").withColumnRenamed("fp", "_fp")
    texts = stored(d.join(found, d["fp"] == found["_fp"]).drop("_fp"), "candidate-texts")
    starts = repeated_windows(texts).groupBy("fp").agg(F.collect_list("start").alias("starts"))
    starts = stored(starts, "repeats").withColumnRenamed("fp", "_fp")
    cut = texts.join(starts, texts["fp"] == starts["_fp"]).drop("_fp").mapInArrow(
        _cut, "fp long, n_removed long, kept string").dropDuplicates(["fp"])
    cut = cut.withColumnRenamed("fp", "_fp").withColumnRenamed("n_removed", "_cut")
    whole = copied.select(F.col("fp").alias("_all")).distinct()
    out = own.join(cut, own["fp"] == cut["_fp"], "left").join(whole, own["fp"] == whole["_all"], "left")
    gone = F.col("_all").isNotNull()
    return out.select(
        "doc_id", "fp", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("_cut", F.lit(0))).cast("long").alias("n_removed"),
        "sha", F.when(gone, F.lit("")).otherwise(F.col("kept")).alias("kept"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per row of docs."""
    k = kept_words(docs)
    return k.select("doc_id", "n_words", "n_removed",
                    F.when(F.col("kept").isNull(), F.col("sha"))
                    .otherwise(F.sha2(F.encode(F.coalesce("kept", F.lit("")), "UTF-8"), 256)).alias("kept_sha256"))
