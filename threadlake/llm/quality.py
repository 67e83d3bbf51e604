"""Quality rules as weak supervision.

Every rule looks at counts of the whole text and votes good (1), bad (-1) or
abstains (0).  Expectation-maximisation learns, without labels, how accurate the
votes of each rule are; the posterior probability of "good" given all votes
replaces an all-must-pass filter.

Only the table of distinct vote patterns (at most 3^rules rows, whatever the
number of documents) reaches the driver for EM; it is counted over all rows.
The posterior is then a sum of per-rule log ratios, a Spark expression.

Defined cases: null text has no words; a document without words, or one that
fails the base test, is rejected; repeated rows are judged alike and count each in
learning; a posterior of just ``KEEP_FROM`` keeps; very long texts are counted whole;
other columns may have any name; an empty table gives no row and no model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.llm.common import packed, ready, stored

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
KEEP_FROM = 0.5
#: What the votes of a rule are built for: bad votes name a defect, good ones only
#: hint.  Every rule begins with ``MASS`` votes of that accuracy, however many rows
#: there are; the trusted rules with ``TRUST`` for each vote that they cast.  The
#: rules that vote good are trusted: nearly every text has their votes, so without
#: a hold the share of good texts and their accuracy fall together as rows grow.
ACCURACY, MASS, TRUST = (0.95, 0.85), 20.0, 2.0
TRUSTED = ("symbols", "many_words", "varied_words")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper_words", "n_stress_words", "n_distinct_words")


def _repeated(words: list[bytes], n_distinct: int, ids: np.ndarray) -> int:
    """Words inside 3-word windows found at least twice in the text."""
    if len(words) < 4:
        return 0
    if n_distinct < 1 << 21:
        key = (ids[:-2] * n_distinct + ids[1:-1]) * n_distinct + ids[2:]
    else:  # pair ids first, so that the key stays inside 64 bits
        _, pair = np.unique(ids[:-1] * n_distinct + ids[1:], return_inverse=True)
        key = pair[:-1] * n_distinct + ids[2:]
    _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
    again = n[inverse] > 1
    cover = np.zeros(len(words), bool)
    for k in range(3):
        cover[k:len(again) + k] |= again
    return int(cover.sum())


def count_text(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = raw.split()  # bytes split at U+0020 and U+0009..U+000D only
    if not words:
        return (0,) * len(COUNTS)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    chars = len(text) - len(raw) + sum(map(len, words))  # code points: gaps are one byte each
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.encode().split():
            lines += 1
            dup += line in seen
            seen.add(line)
    distinct = [w.decode() for w in known]
    upper = np.array([w.isupper() and len(w) > 1 for w in distinct])
    stress = np.array([w.endswith("!") for w in distinct])
    return (len(words), chars, sum(text.count(c) for c in SYMBOLS), dup, _repeated(words, len(known), ids),
            lines, int(upper[ids].sum()), int(stress[ids].sum()), len(known))


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _counts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for part in texts:
        yield pd.DataFrame([count_text(t) for t in part], columns=list(COUNTS))


def with_counts(docs: DataFrame) -> DataFrame:
    """docs plus a struct column ``_c`` of counts over the whole text."""
    ready(docs.sparkSession)
    return docs.withColumn("_c", _counts(F.col("text")))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def votes(c: Column) -> dict[str, Column]:
    """Rule name → vote.  Shares are per word, line shares per line.  A rule that
    sees nothing wrong abstains; only two look for signs of a good text."""
    words, lines = F.greatest(c["n_words"], F.lit(1)), F.greatest(c["n_lines"], F.lit(1))

    def bad(when: Column) -> Column:
        return F.when(when, -1).otherwise(0)

    length = c["word_chars"] / words
    return {
        "too_short": bad(c["n_words"] < MIN_WORDS),
        "symbols": bad(c["n_symbols"] > 0.1 * words),
        "repeated_words": bad(c["n_repeat_words"] > 0.3 * words),
        "repeated_lines": bad((c["n_dup_lines"] > 0.35 * lines) & (c["n_lines"] > 2)),
        "word_length": bad((length < 2.5) | (length > 12)),
        "capitals": bad(c["n_upper_words"] > 0.3 * words),
        "stress": bad(c["n_stress_words"] > 0.2 * words),
        "few_words_over_and_over": bad(c["n_distinct_words"] < 0.1 * c["n_words"]),
        "many_words": F.when(c["n_words"] >= 4 * MIN_WORDS, 1).otherwise(0),
        "varied_words": F.when((c["n_words"] >= MIN_WORDS) & (c["n_distinct_words"] > 0.4 * c["n_words"]), 1).otherwise(0),
    }


def learn(patterns: np.ndarray, n: np.ndarray, trusted: tuple[int, ...] = (), rounds: int = 500,
          tol: float = 1e-10) -> tuple[float, np.ndarray]:
    """EM over vote patterns (rows of -1/0/1) seen ``n`` times each.

    The unknown is each document's class; an abstention says nothing.  Returns
    the share of good documents and the accuracy of every rule's bad and good
    votes (the share of those votes that are right), an array (rule, 2).  All
    accuracies are learned, from ``MASS`` votes of ``ACCURACY`` to begin with;
    rules in ``trusted`` anchor which class is the bad one.
    """
    cast = [patterns < 0, patterns > 0]
    good = np.where(cast[0].any(1), 0.1, 0.9)
    accuracy = np.tile(ACCURACY, (patterns.shape[1], 1))
    anchor = np.isin(np.arange(patterns.shape[1]), trusted)
    share = float((n * good).sum() / n.sum())
    for _ in range(rounds):
        odds = math.log(share / (1 - share))
        logit = odds + cast[0] @ _weight(accuracy[:, 0], -odds, -1) + cast[1] @ _weight(accuracy[:, 1], odds, 1)
        good = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        new = accuracy.copy()
        for side, right in ((0, 1 - good), (1, good)):
            seen = (cast[side] * n[:, None]).sum(0)
            agreed = (cast[side] * (n * right)[:, None]).sum(0)
            mass = np.where(anchor & (seen > 0), TRUST * seen, MASS)
            new[:, side] = (agreed + mass * ACCURACY[side]) / (seen + mass)
        new_share = float(np.clip((n * good).sum() / n.sum(), 1e-4, 1 - 1e-4))
        moved = max(abs(new_share - share), float(abs(new - accuracy).max()))
        accuracy, share = new, new_share
        if moved < tol:
            break
    return share, accuracy


def _weight(accuracy: np.ndarray, odds: float, sign: int) -> np.ndarray:
    """What a vote adds to the log odds of "good": the odds that it is right,
    over the odds of its side without it.  A rule whose votes are right less
    often than without it counts for the other side."""
    a = np.clip(accuracy, 1e-4, 1 - 1e-4)
    return sign * (np.log(a / (1 - a)) - odds)


def fit(counted: DataFrame) -> dict[str, tuple[float, float]] | None:
    """Learn from the votes of all rows.  Returns per rule what a bad and a good
    vote add to the log odds, and under "" the prior odds; None without rows."""
    v = votes(F.col("_c"))
    rows = counted.groupBy(*[x.alias(k) for k, x in v.items()]).agg(F.count(F.lit(1)).alias("n")).collect()
    if not rows:
        return None
    rows = sorted(rows, key=lambda r: [r[k] for k in v])
    share, accuracy = learn(np.array([[r[k] for k in v] for r in rows]), np.array([float(r["n"]) for r in rows]),
                            tuple(i for i, k in enumerate(v) if k in TRUSTED))
    odds = math.log(share / (1 - share))
    bad, good = _weight(accuracy[:, 0], -odds, -1), _weight(accuracy[:, 1], odds, 1)
    return {"": (odds, odds)} | {k: (float(bad[i]), float(good[i])) for i, k in enumerate(v)}


def judged(counted: DataFrame, model: dict[str, tuple[float, ...]] | None) -> DataFrame:
    """counted plus ``quality`` (posterior) and ``kept``."""
    if model is None:
        return counted.withColumn("quality", F.lit(None).cast("double")).withColumn("kept", F.lit(False))
    logit = F.lit(model[""][0])
    for k, x in votes(F.col("_c")).items():
        bad, good = model[k]
        logit = logit + F.when(x < 0, F.lit(bad)).when(x > 0, F.lit(good)).otherwise(F.lit(0.0))
    return (counted.withColumn("quality", 1 / (1 + F.exp(-logit)))
            .withColumn("kept", ~base_failed(F.col("_c")) & (F.col("quality") >= KEEP_FROM)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) → doc_id, counts, base_failed, votes, quality, kept."""
    counted = stored(with_counts(docs.select("doc_id", "text")).drop("text"), "quality")
    out = judged(counted, fit(counted))
    c = F.col("_c")
    return out.select("doc_id", *[c[x].alias(x) for x in COUNTS[:5]],
        base_failed(c).alias("base_failed"), "kept", "quality",
        *[x.cast("int").alias(f"vote_{k}") for k, x in votes(c).items()])


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that ``quality_rules`` keeps, unchanged.  The model is
    learned in a first pass over all texts; nothing is joined back by id."""
    counted = stored(with_counts(docs.select("text")).drop("text"), "quality")
    return judged(with_counts(packed(docs, "text")), fit(counted)).filter("kept").select("doc.*")
