"""Secret scan with a random forest that removes false positives.

1. Candidates: whole runs of 16 or more key characters that hold a digit or mix
   their case, and what is assigned to a credential name, of any length and
   characters; with where they stand: the words before, the assignment or path
   around.
2. Features: length, character classes and entropy, transitions (how often two
   neighbours change class, and how usual each pair of letters is in the corpus's
   own words), coverage by corpus words (dictionary), path-likeness, and whether
   the neighbouring words name a credential.
3. A random forest (pyspark.ml) trained on labelled findings says which
   candidates are secrets.

Labelled findings can be given (columns of ``candidates`` plus ``label``).
Otherwise they are made from the corpus: true findings are random keys of the
known formats put behind credential words into contexts of real candidates and
words; false ones are identifiers, numbers, words, paths and digests built the
same way.  At most ``FINDINGS`` are made, a documented parameter; the corpus
statistics (letter pairs, dictionary words) count every text.

Defined cases: null and empty texts have no candidate; repeated rows repeat
their findings; without any word in the corpus no candidate is left out by the
dictionary; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlake.llm.common import ready, stored

FINDINGS = 4000
DICTIONARY = 5000
TREES, DEPTH, SEED = 40, 8, 11
THRESHOLD = 0.5
LEAST = 16

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.\-]{%d,}" % LEAST)
#: A name and its assignment; what is assigned (quoted, or up to a space).
ASSIGNED = re.compile(r"""(?<![\w.\-])([\w.\-]++)["']?[ \t]*(?:=>|:=|={1,3}|:)[ \t]*""")
VALUE = re.compile(r"""(?:"((?:[^"\\\n]|\\.)++)"|'((?:[^'\\\n]|\\.)++)'|["']?([^\s"']++))""")
#: Words that name a credential (fixed values).
NAMES = ("key", "token", "secret", "passwd", "password", "pwd", "auth", "bearer", "credential", "api", "access", "private")
#: What known keys begin with (fixed values).
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk_live_", "sk-", "xoxb-", "AIza", "eyJ", "glpat-")
FEATURES = ("length", "digits", "upper", "lower", "other", "entropy", "changes", "pairs", "dictionary",
            "slashes", "dots", "hex", "named", "assigned", "quoted", "prefixed")


def _names_credential(name: str) -> bool:
    return any(p.startswith(NAMES) or p.endswith(NAMES) for p in
               (w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", name)))


def _assigned(text: str) -> Iterator[tuple[int, str, bool]]:
    """(start, value, whole: quoted and without spaces) of what credential names get."""
    for m in ASSIGNED.finditer(text):
        v = VALUE.match(text, m.end()) if _names_credential(m.group(1)) else None
        if v:
            k = v.lastindex
            value = v.group(k) if k < 3 else v.group(k).rstrip(",;")
            if value:
                yield v.start(k), value, k < 3 and not any(c.isspace() for c in value)


def candidates(text: str | None) -> Iterator[tuple[int, str, str, str]]:
    """(start, value, text before, character after) of each candidate.  A run
    inside a quoted value that is a candidate itself is not one more."""
    if not text:
        return
    assigned = list(_assigned(text))
    whole = iter([(s, s + len(v)) for s, v, w in assigned if w])
    here, got = next(whole, None), {(s, v) for s, v, _ in assigned}
    for m in CANDIDATE.finditer(text):
        value, start = m.group(), m.start()
        cut = re.match(r"[A-Za-z_.\-]{1,40}=(?=[^=])", value)  # name=value
        if cut:
            value, start = value[cut.end():], start + cut.end()
        value = value.rstrip("=.-") if not value.endswith("==") else value
        has_digit = any(c.isdigit() for c in value)
        mixed = value != value.lower() and value[1:] != value[1:].lower()
        while here and here[1] <= start:
            here = next(whole, None)
        inside = here and here[0] <= start and start + len(value) <= here[1]
        if len(value) >= LEAST and (has_digit or mixed) and not inside:
            got.add((start, value))
    for start, value in sorted(got):
        yield start, value, text[max(0, start - 40):start], text[start + len(value):start + len(value) + 1]


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def features(value: str, before: str, after: str, pairs: dict[str, float], dictionary: set[str]) -> list[float]:
    """The numbers of FEATURES for one candidate."""
    n = len(value)
    kinds = [_kind(c) for c in value]
    share = [kinds.count(k) / n for k in range(4)]
    entropy = -sum(p * math.log2(p) for p in (value.count(c) / n for c in set(value)))
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1)
    low = value.lower()
    letters = [low[i:i + 2] for i in range(n - 1) if low[i:i + 2].isalpha()]
    usual = sum(pairs.get(p, math.log(1e-5)) for p in letters) / len(letters) if letters else 0.0
    covered = sum(len(w) for w in re.findall(r"[a-z]{3,}", low) if w in dictionary) / n
    words = re.findall(r"[a-z]+", before.lower())[-3:]
    return [float(n), *share, entropy, changes, usual, covered, value.count("/") / n, value.count(".") / n,
            float(all(c in string.hexdigits for c in value)), float(any(w in NAMES for w in words)),
            float(bool(re.search(r"[=:]\s*[\"']?$", before))), float(before[-1:] in "\"'" and before != "" and after in "\"'" and after != ""),
            float(value.startswith(PREFIXES))]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(i, s, v, p, a) for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)
                for s, v, p, a in candidates(t)]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], b.column("doc_id").type), pa.array(cols[1], pa.int64()),
             *[pa.array(c, pa.string()) for c in cols[2:]]],
            names=["doc_id", "start", "value", "before", "after"])


def find(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) → doc_id, start, value, before, after."""
    ready(docs.sparkSession)
    id_type = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        _find, f"doc_id {id_type}, start long, value string, before string, after string")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: letter pairs and words (3 to 12 letters) with their counts."""
    from collections import Counter

    pairs, words = Counter(), Counter()

    def out():
        both = [("pair", k, n) for k, n in pairs.items()] + [("word", k, n) for k, n in words.items()]
        cols = list(zip(*both, strict=True)) if both else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                                           pa.array(cols[2], pa.int64())], names=["kind", "item", "n"])

    for b in batches:
        some = Counter()
        for t in b.column("text").to_pylist():
            some.update(w for w in (t or "").lower().split() if w.isascii() and w.isalpha())
        for w, n in some.items():
            for i in range(len(w) - 1):
                pairs[w[i:i + 2]] += n
            if 3 <= len(w) <= 12:
                words[w] += n
        if len(words) > 300_000:
            yield out()
            pairs.clear()
            words.clear()
    yield out()


def statistics(docs: DataFrame) -> tuple[dict[str, float], list[str]]:
    """(log share of each letter pair, the DICTIONARY most frequent words),
    counted over all texts; 676 pairs at most."""
    ready(docs.sparkSession)
    n = stored(docs.select("text").mapInArrow(_count, "kind string, item string, n long")
               .groupBy("kind", "item").agg(F.sum("n").alias("n")), "secret-statistics")
    pairs = {r["item"]: r["n"] for r in n.filter("kind = 'pair'").collect()}
    total = sum(pairs.values()) or 1
    words = [r["item"] for r in n.filter("kind = 'word'").orderBy(F.desc("n"), "item").limit(DICTIONARY).collect()]
    return {k: math.log(v / total) for k, v in pairs.items()}, words


def made_findings(words: list[str], n: int = FINDINGS) -> list[tuple[str, str, str, int]]:
    """(value, before, after, label): labelled findings built from corpus words."""
    rng = np.random.default_rng(SEED)
    words = words or ["value", "name", "item"]
    some = lambda a, k: "".join(rng.choice(list(a), k))
    word = lambda: str(rng.choice(words))
    hexes, alnum = "0123456789abcdef", string.ascii_letters + string.digits

    def key() -> tuple[str, bool]:
        kind = rng.integers(8)
        if kind == 6:
            return some(string.ascii_letters, int(rng.integers(20, 48))), False
        if kind == 7:  # a password
            return some(alnum, int(rng.integers(5, 12))) + some("!@#$%&*?^~", 1) + some(alnum, int(rng.integers(1, 4))), False
        if kind == 0:
            return "AKIA" + some(string.ascii_uppercase + string.digits, 16), True
        if kind == 1:
            return some(hexes, int(rng.choice([16, 18, 20, 24, 32, 40, 64]))), False
        if kind == 2:
            return some(alnum, int(rng.integers(20, 48))), False
        if kind == 3:
            return str(rng.choice(PREFIXES[2:])) + some(alnum, int(rng.integers(20, 40))), True
        if kind == 4:
            return some(alnum + "+/", 40), False
        return some(alnum + "-_", int(rng.integers(22, 44))), False

    def plain() -> tuple[str, str, str]:
        kind = rng.integers(11)
        lead = f"{word()} {word()} "
        name = str(rng.choice(NAMES))
        if kind == 8:
            return "".join(word().title() for _ in range(int(rng.integers(3, 6)))), lead, " "
        if kind == 9:  # a word, assigned
            shape = rng.integers(3)
            return word(), lead + name + [": ", " = ", ' = "'][shape], '"' if shape == 2 else " "
        if kind == 10:  # a call, a lookup, a place holder
            return str(rng.choice([f"{word()}.{word()}()", f"<{word()}>", "${" + word().upper() + "}", f"{word()}_{word()}",
                                   f"{word()}[{word()}]"])), lead + name + " = ", " "
        if kind == 0:
            return some(string.digits, int(rng.integers(16, 20))), lead, " "
        if kind == 1:
            return "/".join(word() for _ in range(4)) + f"/{rng.integers(9999)}", lead + "/", " "
        if kind == 2:
            return ".".join([word(), word(), f"mail{rng.integers(99)}", "example.com"]), lead, " "
        if kind == 3:  # digest in running text
            return some(hexes, int(rng.choice([32, 40, 64]))), lead + str(rng.choice(["commit ", "digest ", "id ", "sum "])), " "
        if kind == 4:
            return "-".join(some(hexes, k) for k in (8, 4, 4, 4, 12)), lead, " "
        if kind == 5:
            return "_".join(word() for _ in range(3)) + f"_{rng.integers(999)}", lead, " "
        if kind == 6:
            return word().title() + word().title() + word().title() + str(rng.integers(99)), lead, " "
        return f"{rng.integers(1990, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}T{rng.integers(10, 24)}.{rng.integers(10, 60)}", lead, " "

    out = []
    while len(out) < n:
        value, known = key()
        name = str(rng.choice(NAMES))
        lead = f"{word()} {word()} {name}"
        shape = rng.integers(4)
        if known and shape == 0:
            out.append((value, f"{word()} {word()} ", " ", 1))
        elif shape == 1:
            out.append((value, lead + ' = "', '"', 1))
        elif shape == 2:
            out.append((value, lead + "=", " ", 1))
        else:
            out.append((value, lead + ": ", " ", 1))
        p = plain()
        if len(p[0]) >= LEAST or p[1].endswith((": ", "= ", '= "')):
            out.append((*p, 0))
    return out[:n]


def scored(found: DataFrame, labelled: list[tuple[str, str, str, int]], pairs: dict[str, float],
           words: list[str]) -> DataFrame:
    """found plus ``score`` of the forest trained on the labelled findings."""
    spark: SparkSession = found.sparkSession
    dictionary = set(words)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [features(v, p, a, pairs, dictionary) for v, p, a in
                 zip(*[b.column(c).to_pylist() for c in ("value", "before", "after")], strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(f, pa.list_(pa.float64()))],
                                             names=[*b.schema.names, "features"])

    train = spark.createDataFrame(
        [(float(y), features(v, p, a, pairs, dictionary)) for v, p, a, y in labelled], "label double, features array<double>")
    train = train.withColumn("features", array_to_vector("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(train)
    kinds = ", ".join(f"`{n}` {t}" for n, t in found.dtypes)
    x = found.mapInArrow(numbers, f"{kinds}, features array<double>").withColumn("features", array_to_vector("features"))
    return (forest.transform(x).withColumn("score", vector_to_array("probability")[1])
            .drop("features", "rawPrediction", "probability", "prediction"))


def scan(docs: DataFrame, labelled: list[tuple[str, str, str, int]] | None = None) -> DataFrame:
    """docs(doc_id, text) → one row per candidate: doc_id, start, length,
    masked, value_sha256, score, secret."""
    pairs, words = statistics(docs)
    found = stored(find(docs), "secret-candidates")
    out = scored(found, labelled or made_findings(words), pairs, words)
    masked = F.concat(F.substring("value", 1, 4), F.repeat(F.lit("*"), 8))
    return out.select("doc_id", "start", F.length("value").cast("long").alias("length"), masked.alias("masked"),
                      F.sha2(F.encode("value", "UTF-8"), 256).alias("value_sha256"), F.round("score", 6).alias("score"),
                      (F.col("score") >= THRESHOLD).alias("secret"))


def sha(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()
