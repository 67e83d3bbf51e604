"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max
inverted index, distance-weighted votes, calibrated scores, evidence.

Learning (labels of the training rows only):

* Terms are lower-cased words and their first ``STEMS`` letters.  How many toxic
  and other training texts hold a term is counted over all of them (a Spark
  aggregate).  A term weighs its idf times its information: how far, in nats,
  the texts that hold it lean to one label, both labels counted alike and
  ``DOUBT`` texts without a label added.  No term is left out; those that say
  nothing of the label weigh next to nothing.
* Examples: at most ``EXAMPLES`` different labelled rows, half of them of either
  label, the least by a hash of text and doc_id - the bounded sample of this
  operator.  The hashes are picked from a narrow table; texts never go to the
  driver, only the examples' sparse vectors do.
* Index: postings of every term of every example, in blocks of ``BLOCK`` similar
  examples, with the greatest weight per (term, block).

Scoring one text, whole: the most frequent terms, which hold most postings, are
added up as rows of numbers, for many texts in one matrix product (in single
precision, with a bound on what rounding can hide); the strongest others over
their postings; block maxima bound what the rest can still add to an example;
examples that can reach the ``NEAREST`` best are finished.  More terms are added
first while such examples are many.  The result is exact.  A term that no example
holds counts in the text's length as one seen in one other training text.  The
neighbours vote with their cosine, and a logistic curve fitted on the examples
(each without itself and its copies) turns the vote into a probability.

Defined cases: null and empty texts have no terms and get the score of "no
evidence"; labels of null or unknown doc_ids are not used; a doc_id with several
labels counts as toxic if any is; repeated rows count in the statistics and are
one example; ties go to the example that comes first in the index; very long
texts are read whole; other columns, whatever their names, are not read; without
training rows of both labels every score is the known share of toxic rows (0
without labels); an empty table gives no row.  doc_id, source, lang and labels
never enter a score.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Collection, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import ready, stored

STEMS = (4, 5)
#: Terms of a word at most.
WIDTH = 1 + len(STEMS)
#: Texts without a label that every term is taken to be in, besides those counted.
DOUBT = 2.0
#: Information of a term that leans to no label, in nats: no term is dropped.
LEAST = 1e-6
EXAMPLES = 4096
BLOCK = 64
NEAREST = 16
#: Other terms added up first, and examples finished one by one at most before more are.
FIRST, FINISH = 512, 128
#: Terms with a row over all examples at most, the share of them (one in ...) that
#: hold such a term, and texts that are multiplied at once.
FREQUENT, ONE_IN, TOGETHER = 1024, 16, 64
#: Rounding of a sum of ``FREQUENT`` products, none below 0: at most this part of it.
ROUNDING = (FREQUENT + 8) * 2.0 ** -24
#: Words whose terms a task remembers, terms that it counts before it passes them on.
REMEMBER, COUNTED = 200_000, 500_000
#: Labels (16 bytes each) that are broadcast at most.
BROADCAST_LABELS = 1_000_000
PRIOR_WEIGHT = 0.25
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")
#: The same for texts of ASCII alone: what is no letter becomes a space.
_GAPS = {i: " " for i in range(128) if not _WORD.match(chr(i))}


def words_of(text: str | None) -> list[str]:
    """The lower-cased words of a text."""
    text = (text or "").lower()
    return text.translate(_GAPS).split() if text.isascii() else _WORD.findall(text)


def terms(word: str) -> list[str]:
    """A lower-cased word and its beginnings."""
    out, n = [word], len(word)
    for k in STEMS:
        if n > k:
            out.append(word[:k] + "*")
    return out


def term_weights(clean: np.ndarray, toxic: np.ndarray, n: dict[int, int]) -> np.ndarray:
    """idf times information of terms held by so many texts of each label."""
    idf = np.log((n[0] + n[1] + 1) / (clean + toxic + 1)) + 1
    half = (n[0] + n[1]) / 2  # both labels count alike
    t, c = toxic * (half / n[1]), clean * (half / n[0])
    p = np.clip((t + DOUBT / 2) / (t + c + DOUBT), 1e-12, 1 - 1e-12)
    return idf * np.maximum(p * np.log(2 * p) + (1 - p) * np.log(2 * (1 - p)), LEAST)


class Numbers(dict):
    """Word → its place in a list of the numbers of its terms (-1: no more).  A
    term that is not in the vocabulary gets the next number."""

    def __init__(self, vocabulary: list[str]):
        self.term = {t: i for i, t in enumerate(vocabulary)}
        self.list = array("i")

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        term, add = self.term, self.list.append
        got = terms(word)
        for t in got:
            i = term.get(t)
            if i is None:
                i = term[t] = len(term)
            add(i)
        for _ in range(WIDTH - len(got)):
            add(-1)
        return place

    def of(self, words: Collection[str]) -> np.ndarray:
        """A row of term numbers per word."""
        place = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(self.list, np.int32).reshape(-1, WIDTH)[place]


class Terms:
    """Numbers and weights of the examples' terms; texts to sparse vectors."""

    def __init__(self, vocabulary: list[str], weight: np.ndarray, unseen: float):
        self.vocabulary, self.weight, self.unseen = vocabulary, weight, unseen
        self._numbers: Numbers | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_numbers": None}

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers, rising, and weights of a text's vector of length 1; what
        no example holds is in the length only."""
        words = Counter(words_of(text))
        if self._numbers is None or len(self._numbers) > REMEMBER:
            self._numbers = Numbers(self.vocabulary)
        at = self._numbers.of(words)
        times = np.repeat(np.fromiter(words.values(), float, len(words)), WIDTH)
        at = at.ravel()
        some = at >= 0
        at, which = np.unique(at[some], return_inverse=True)
        n = 1 + np.log(np.bincount(which, times[some]))
        held = np.searchsorted(at, len(self.vocabulary))
        if not held:
            return np.zeros(0, np.int32), np.zeros(0)
        w = n[:held] * self.weight[at[:held]]
        # by size: the numbers of new terms depend on the texts before
        other = np.sort(n[held:]) * self.unseen
        return at[:held], w / math.sqrt(float(w @ w) + float(other @ other))


class Index:
    """Block-max inverted index over bounded examples, frequent terms as rows."""

    def __init__(self, words: Terms, vectors: list[tuple[np.ndarray, np.ndarray]], label: list[int], ids: list, prior: float):
        # neighbours in this order share their strongest term: tight block maxima
        top = [(int(at[w.argmax()]), float(w.max())) if len(at) else (-1, 0.0) for at, w in vectors]
        order = sorted(range(len(vectors)), key=lambda i: (top[i], i))
        self.words, self.prior, self.curve = words, prior, (1.0, 0.0)
        self.y, self.ids = np.array([float(label[i]) for i in order]), [ids[i] for i in order]
        self.start = np.concatenate([[0], np.cumsum([len(vectors[i][0]) for i in order], dtype=np.int64)])
        self.at = np.concatenate([np.zeros(0, np.int32), *[vectors[i][0] for i in order]]).astype(np.int32)
        self.w = np.concatenate([np.zeros(0), *[vectors[i][1] for i in order]]).astype(np.float32)
        self._ready = False

    def __getstate__(self) -> dict:
        own = ("words", "prior", "curve", "y", "ids", "start", "at", "w")  # postings are made where they are used
        return {k: self.__dict__[k] for k in own} | {"_ready": False}

    def _invert(self) -> None:
        place = np.repeat(np.arange(len(self.y), dtype=np.int32), np.diff(self.start))
        by = np.argsort(self.at, kind="stable")  # by term, then by place
        term = self.at[by]
        self.place, self.pw = place[by].astype(np.int64), self.w[by]
        n = len(self.words.vocabulary)
        self.pstart = np.searchsorted(term, np.arange(n + 1))
        # rows of the frequent terms: weights over all examples
        held = np.diff(self.pstart)
        often = np.argsort(-held, kind="stable")[:FREQUENT]
        often = often[held[often] * ONE_IN >= max(1, len(self.y))]
        self.row = np.full(n, -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.rows = np.zeros((len(often), len(self.y)), np.float32)
        for r, t in enumerate(often):
            p = slice(self.pstart[t], self.pstart[t + 1])
            self.rows[r, self.place[p]] = self.pw[p]
        # greatest weight per (term, block)
        block = self.place // BLOCK
        new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(term) else []
        self.block = block[new].astype(np.int64)
        self.peak = np.maximum.reduceat(self.pw, new) if len(new) else np.zeros(0, np.float32)
        self.bstart = np.searchsorted(term[new], np.arange(n + 1))
        self.most = np.zeros(n)
        np.maximum.at(self.most, term, self.pw)
        self.query = np.zeros(n)
        self.blocks = -(-len(self.y) // BLOCK)
        self._ready = True

    def frequent(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the frequent terms of each vector add to each example."""
        if not self._ready:
            self._invert()
        asked = np.zeros((len(vectors), len(self.rows)), np.float32)
        for i, (at, w) in enumerate(vectors):
            row = self.row[at]
            asked[i, row[row >= 0]] = w[row >= 0]
        return asked @ self.rows

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int = NEAREST, without: np.ndarray | None = None,
                begun: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine above 0 (ties by place): exact.
        ``without`` are places left out, however many they are; ``begun`` is the
        vector's row of ``frequent``, if it is at hand."""
        if not len(at) or not len(self.y):
            return np.zeros(0, int), np.zeros(0)
        often = self.frequent([(at, w)])[0] if begun is None else begun
        row = self.row[at]
        left = row < 0
        term, tw = at[left], w[left]
        if len(term) > FIRST:  # the strongest first
            strong = np.argsort(-(tw * self.most[term]), kind="stable")
            term, tw = term[strong], tw[strong]
        added, done, upto = np.zeros(len(self.y)), 0, FIRST
        if without is not None:
            added[without] = -np.inf  # whatever is added
        while True:
            some = slice(done, upto)
            i, share = _ranges(self.pstart, term[some], tw[some])
            added += np.bincount(self.place[i], share * self.pw[i], len(self.y))
            done, upto = upto, 2 * upto
            scores = reach = added + often
            if done < len(term):  # what the other terms can add, by block
                i, share = _ranges(self.bstart, term[done:], tw[done:])
                rest = np.bincount(self.block[i], share * self.peak[i], self.blocks)
                reach = scores + np.repeat(rest, BLOCK)[:len(scores)]
            least = max(0.0, np.partition(scores, -k)[-k]) if len(scores) >= k else 0.0
            # either side may be off by its rounding
            place = np.flatnonzero((reach > 0) & (reach >= least * (1 - 2 * ROUNDING) - 1e-9))
            if len(place) <= FINISH or done >= len(term):
                break
        # the frequent terms again, in double precision, and those not added yet
        rows = self.rows[row[~left][:, None], place]
        exact = added[place] + (w[~left][:, None] * rows).sum(axis=0)
        if done < len(term) and len(place):
            self.query[term[done:]] = tw[done:]
            i, _ = _ranges(self.start, place, place)
            ends = np.cumsum(self.start[place + 1] - self.start[place])
            exact += np.add.reduceat(self.query[self.at[i]] * self.w[i], np.concatenate([[0], ends[:-1]]))
            self.query[term[done:]] = 0
        top = np.lexsort((place, -exact))[:k]
        top = top[exact[top] > 0]
        return place[top], exact[top]

    def vote(self, place: np.ndarray, score: np.ndarray) -> float:
        """Cosine-weighted share of toxic neighbours, with a little prior."""
        return (float((score * self.y[place]).sum()) + PRIOR_WEIGHT * self.prior) / (float(score.sum()) + PRIOR_WEIGHT)

    def scores(self, texts: list[str | None]) -> Iterator[tuple[float, list, list]]:
        """Per text: score, ids and cosines of its neighbours."""
        a, b = self.curve
        for i in range(0, len(texts), TOGETHER):
            vectors = [self.words.vector(t) for t in texts[i:i + TOGETHER]]
            for (at, w), begun in zip(vectors, self.frequent(vectors), strict=True):
                place, cosine = self.nearest(at, w, begun=begun)
                logit = a * _logit(self.vote(place, cosine)) + b
                yield 1 / (1 + math.exp(-logit)), [self.ids[p] for p in place], [float(c) for c in cosine]

    def calibrate(self, weight: np.ndarray) -> None:
        """Logistic curve over leave-one-out votes; ``weight`` undoes the
        sampling of the examples.  Copies of an example do not vote on it."""
        vectors = [(self.at[i:j], self.w[i:j]) for i, j in zip(self.start[:-1], self.start[1:], strict=True)]
        same: dict[bytes, list[int]] = {}
        names = [at.tobytes() + w.astype(np.float16).tobytes() for at, w in vectors]
        for i, name in enumerate(names):
            same.setdefault(name, []).append(i)
        v, votes = np.zeros(len(self.y)), {}
        for i, (at, w) in enumerate(vectors):
            if names[i] not in votes:  # copies have the same neighbours
                votes[names[i]] = self.vote(*self.nearest(at, w.astype(float), without=np.array(same[names[i]])))
            v[i] = _logit(votes[names[i]])
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton, with a little ridge towards the raw vote
            p = 1 / (1 + np.exp(-np.clip(a * v + b, -30, 30)))
            g = np.array([(weight * (p - self.y) * v).sum() + (a - 1), (weight * (p - self.y)).sum() + 0.01 * b])
            r = weight * p * (1 - p)
            h = np.array([[(r * v * v).sum() + 1, (r * v).sum()], [(r * v).sum(), r.sum() + 0.01]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
            if abs(step).max() < 1e-8:
                break
        if a > 0:  # a vote for the label never lowers a score
            self.curve = (float(a), float(b))


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def _ranges(start: np.ndarray, which: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places start[x] .. start[x+1]-1 of every x in which, and its value at each."""
    first, n = start[which], start[which + 1] - start[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - ends + n, n), np.repeat(value, n)


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: term → texts of each label, and examples, that have it (summed in the task)."""
    numbers, counts = Numbers([]), np.zeros((1024, 3), np.int64)
    for b in batches:
        for text, toxic, picked in zip(*[b.column(c).to_pylist() for c in ("text", "toxic", "picked")], strict=True):
            at = np.unique(numbers.of(set(words_of(text))))
            at = at[at >= 0]
            while len(counts) < len(numbers.term):
                counts = np.concatenate([counts, np.zeros_like(counts)])
            counts[at, toxic] += 1
            counts[at, 2] += picked
            if len(numbers.term) > COUNTED:
                yield _pack(numbers, counts)
                numbers, counts = Numbers([]), np.zeros((1024, 3), np.int64)
    if numbers.term:
        yield _pack(numbers, counts)


def _pack(numbers: Numbers, counts: np.ndarray) -> pa.RecordBatch:
    n = len(numbers.term)
    return pa.RecordBatch.from_arrays([pa.array(list(numbers.term), pa.string()), *[pa.array(counts[:n, k]) for k in range(3)]],
                                      names=["term", "clean", "toxic", "picked"])


def cuts(training: DataFrame, n: dict[int, int], half: int = EXAMPLES // 2) -> dict[int, int]:
    """Label → the hash up to which its rows are examples: ``half`` different
    hashes at most.  Only hashes below an expected cut are sorted."""
    out = {}
    for y, rows in n.items():
        share = (half + 8 * math.sqrt(half)) / rows
        while True:
            some = training.filter(F.col("toxic") == y).select("h").distinct()
            if share < 1:
                some = some.filter(F.col("h") < int(share * 2 ** 63))
            got = [r["h"] for r in some.orderBy("h").limit(half).collect()]
            if len(got) == half or share >= 1:
                break
            share *= 8  # many rows were repeated
        out[y] = got[-1]
    return out


def learn(training: DataFrame) -> Index | None:
    """training(doc_id, text, toxic 0/1) → index; None without both labels."""
    spark = training.sparkSession
    ready(spark)
    training = stored(training.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"),
                                      F.shiftrightunsigned(F.xxhash64("text", "doc_id"), 1).alias("h")), "tox-training")
    n = {r["toxic"]: r["n"] for r in training.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return None
    cut = cuts(training, n)
    picked = F.col("h") <= F.when(F.col("toxic") == 1, F.lit(cut[1])).otherwise(F.lit(cut[0]))
    counted = (training.select("text", "toxic", picked.cast("int").alias("picked"))
               .mapInArrow(_distinct_terms, "term string, clean long, toxic long, picked long").groupBy("term")
               .agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"), F.sum("picked").alias("p")))
    held = counted.filter("p > 0").select("term", "c", "t").toArrow().sort_by("term")  # terms of the examples
    c, t = held["c"].to_numpy().astype(float), held["t"].to_numpy().astype(float)
    words = Terms(held["term"].to_pylist(), term_weights(c, t, n), float(term_weights(np.ones(1), np.zeros(1), n)[0]))
    carried = spark.sparkContext.broadcast(words)  # bounded by the examples' texts
    id_type = dict(training.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(b.column("text").to_pylist()):  # a text a batch: they can be long
                at, w = carried.value.vector(text)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(x).slice(i, 1) for x in ("h", "doc_id", "toxic")], pa.array([at], pa.list_(pa.int32())),
                     pa.array([w.astype(np.float32)], pa.list_(pa.float32()))], names=["h", "doc_id", "toxic", "at", "w"])

    one = (training.filter(picked).groupBy("h", "toxic").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
           .mapInArrow(run, f"h long, doc_id {id_type}, toxic int, at array<int>, w array<float>"))
    got = one.toArrow().sort_by([("toxic", "ascending"), ("h", "ascending")])
    vectors = [(at.values.to_numpy(), w.values.to_numpy().astype(float))
               for at, w in zip(got["at"], got["w"], strict=True)]
    return build(words, vectors, got["toxic"].to_pylist(), got["doc_id"].to_pylist(), n)


def build(words: Terms, vectors: list[tuple[np.ndarray, np.ndarray]], label: list[int], ids: list, n: dict[int, int]) -> Index:
    """Calibrated index over the examples' vectors; n rows of either label."""
    index = Index(words, vectors, label, ids, n[1] / (n[0] + n[1]))
    share = {k: n[k] / max(1, sum(index.y == k)) for k in (0, 1)}
    index.calibrate(np.where(index.y == 1, share[1], share[0]) / sum(n.values()) * len(index.y))
    return index


def score(docs: DataFrame, index: Index | None, prior: float = 0.0) -> DataFrame:
    """docs(doc_id, text) → doc_id, score, evidence (labelled examples with
    their cosine, nearest first)."""
    ready(docs.sparkSession)
    id_type = dict(docs.dtypes)["doc_id"]
    if index is None:
        none = F.array().cast(f"array<struct<doc_id:{id_type},cosine:double>>")
        return docs.select("doc_id", F.lit(float(prior)).alias("score"), none.alias("evidence"))
    held = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the examples' texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, near = [], []
            for s, ids, cosines in held.value.scores(b.column("text").to_pylist()):
                scores.append(s)
                near.append([{"doc_id": i, "cosine": c} for i, c in zip(ids, cosines, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(scores, pa.float64()),
                 pa.array(near, pa.list_(pa.struct([("doc_id", b.column("doc_id").type), ("cosine", pa.float64())])))],
                names=["doc_id", "score", "evidence"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, score double, evidence array<struct<doc_id:{id_type},cosine:double>>")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs(doc_id, text), labels(doc_id, toxic) → doc_id, held_out, score,
    predicted, evidence."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    # labels go to the texts while they are few; beyond, both are shuffled
    few = known.count() <= BROADCAST_LABELS
    training = docs.select("doc_id", "text").join(F.broadcast(known) if few else known, "doc_id")
    index = learn(training)
    prior = 0.0 if index else float(known.agg(F.avg("toxic")).first()[0] or 0.0)
    out = score(docs, index, prior)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
