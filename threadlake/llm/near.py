"""N-gram Jaccard join with MinHash banding at a fixed depth.

Two documents are linked when the Jaccard similarity of their distinct 5-word
shingles is at least ``THRESHOLD``.

1. Texts with the same word sequence form a class; one of each goes on.  Classes
   and groups are named by 64 of the sequence's 128 hash bits.
2. Banding: each of ``TREES`` bands hashes MinHash values of its own, in no
   other band.  Documents that share a band's hash are candidates.  The depth of
   the bands is fixed before any row is read: the greatest at which the recall
   at exactly the threshold reaches ``TARGET_RECALL`` (``depth_for``); pairs
   above the threshold have more.  A forest would try depths from deep to
   shallow per document until enough neighbours are found; here every pair at
   the threshold is wanted, so the shallowest depth is matched anyway and deeper
   ones add nothing.  Buckets are joined by Spark on (band, hash).
3. A bucket links its members to its least member (a star, never all pairs).
   Connected stars are candidate groups, found by hooking and pointer jumping
   over written tables.
4. Exact verification: inside a group documents meet in blocks of at most about
   ``BLOCK``, every pair of blocks in one task with one matrix product over the
   shingles that occur in it more than once.  Links are counted there; only
   counts and one star per linked part leave the task, never all pairs.
5. Verified stars are connected into the final groups.

Defined cases: null and empty texts have no words and form one class (equal
texts) without links to others; texts of 1 to 4 words have one shingle, the
whole text; rows with equal (or null) doc_id and different texts are told apart by
128 bits of the text, equal rows are copies of each other; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import fingerprint, packed, ready, stored
from threadlake.llm.repeats import _Hashes, windows, word_hashes

WIDTH = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.998
TREES = 32
MAX_DEPTH = 16
BLOCK = 256
SEED = 7


def depth_for(threshold: float = THRESHOLD, trees: int = TREES, target: float = TARGET_RECALL,
              max_depth: int = MAX_DEPTH) -> int:
    """Shorten the bands until pairs at the threshold share one with probability ``target``: 1 - (1 - s^depth)^trees, which holds as
    no hash is in two bands."""
    depth = max_depth
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < target:
        depth -= 1
    return depth


def shingle_set(text: str | None, known: _Hashes) -> np.ndarray:
    """Distinct hashes of the 5-word windows (one for 1 to 4 words)."""
    words = (text or "").encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(windows(word_hashes(words, known), min(WIDTH, len(words))))


def _family() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    depth = depth_for()
    hashes = TREES * depth
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, hashes, dtype=np.uint64)
    return odd, add, np.arange(hashes).reshape(TREES, depth)


def minhash(shingles: np.ndarray, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Least value of each hash function over the set."""
    step = max(1, (1 << 15) // len(shingles))  # short sets take many functions at once
    with np.errstate(over="ignore"):
        return np.concatenate([(shingles * odd[k:k + step, None] + add[k:k + step, None]).min(1) >> np.uint64(20)
                               for k in range(0, len(odd), step)])


def prefixes(signature: np.ndarray, paths: np.ndarray, depth: int) -> np.ndarray:
    """One hash per band of its first ``depth`` values."""
    out = np.arange(1, len(paths) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for level in range(depth):
            out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + signature[paths[:, level]]
        return out ^ (out >> np.uint64(29))


def _class_of(text: str | None) -> tuple[int, int, int]:
    """Two hashes of the word sequence, and its length."""
    words = (text or "").encode().split()
    whole = xxhash.xxh3_128_intdigest(b" ".join(words))
    return (whole & (1 << 64) - 1) - (1 << 63), (whole >> 64) - (1 << 63), len(words)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, fingerprint and class of the text, number of words, band hashes (null without words)."""
    odd, add, paths = _family()
    depth, known = depth_for(), _Hashes()
    for b in batches:
        texts = b.column("text").to_pylist()
        of = [_class_of(t) for t in texts]
        trees = [prefixes(minhash(shingle_set(t, known), odd, add), paths, depth).view(np.int64) if c[2] else None
                 for t, c in zip(texts, of, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*[b.column(c) for c in ("doc_id", "f1", "f2")], *[pa.array([c[k] for c in of], pa.int64()) for k in range(3)],
             pa.array(trees, pa.list_(pa.int64()))], names=["doc_id", "f1", "f2", "c1", "c2", "n_words", "path"])


def components(edges: DataFrame, name: str) -> DataFrame:
    """edges(a, b) → node, root: the least node of each connected part.

    Hooking to the least neighbour, then pointer jumping, in rounds until
    nothing changes; every round is written to the shared folder.
    """
    edges = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), f"{name}-edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    root = stored(nodes.select("node", F.col("node").alias("root")), f"{name}-0")
    live, turn = edges, 0
    while True:
        turn += 1
        # edges between current roots that are still different
        ra = root.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = root.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        live = stored(live.join(ra, "a").join(rb, "b").filter("ra != rb")
                      .select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(),
                      f"{name}-live{turn}")
        if live.isEmpty():
            return root
        hook = live.groupBy("a").agg(F.min("b").alias("b"))
        hook = stored(hook, f"{name}-hook{turn}")
        while True:  # follow the hooks down to their ends
            nxt = hook.select(F.col("a").alias("b"), F.col("b").alias("_b"))
            jumped = stored(hook.join(nxt, "b", "left").select("a", F.coalesce("_b", "b").alias("b"),
                                                               F.col("_b").isNotNull().alias("_moved")),
                            f"{name}-jump{turn}")
            moved = not jumped.filter("_moved").isEmpty()
            hook = jumped.drop("_moved")
            if not moved:
                break
        to = hook.select(F.col("a").alias("root"), F.col("b").alias("_to"))
        root = stored(root.join(to, "root", "left").select("node", F.coalesce("_to", "root").alias("root")),
                      f"{name}-{turn}")


def _verify(threshold: float):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        """One pair of blocks of one group: links per member, and for each
        member the least member of its linked part here."""
        part = part.drop_duplicates("node")  # equal rows of one doc_id
        known = _Hashes()
        node, block = part["node"].to_numpy(), part["block"].to_numpy()
        sets = [shingle_set(t, known) for t in part["text"]]
        low, high = part["bi"].iloc[0], part["bj"].iloc[0]
        size = np.array([len(s) for s in sets])
        value, n = np.unique(np.concatenate(sets), return_counts=True)
        value = value[n > 1]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        for at in range(0, len(value), 8192):  # bounded width of the matrix
            some = value[at:at + 8192]
            m = np.zeros((len(sets), len(some)), np.float32)
            for i, s in enumerate(sets):
                at_i = np.searchsorted(some, s)
                ok = at_i < len(some)
                ok[ok] = some[at_i[ok]] == s[ok]
                m[i, at_i[ok]] = 1
            shared += m @ m.T
        union = size[:, None] + size[None, :] - shared
        linked = shared >= threshold * union - 1e-6
        np.fill_diagonal(linked, False)
        if low != high:  # pairs inside a block belong to the task of that block alone
            linked &= block[:, None] != block[None, :]
        root = np.arange(len(node))
        order = np.argsort(node, kind="stable")
        seen = np.zeros(len(node), bool)
        for start in order:  # breadth first from the least member
            if seen[start]:
                continue
            front = np.array([start])
            seen[start] = True
            while len(front):
                root[front] = start
                reach = linked[front].any(0) & ~seen
                seen |= reach
                front = np.flatnonzero(reach)
        return pd.DataFrame({"node": node, "root": node[root], "links": linked.sum(1).astype(np.int64)})

    return run


def near_join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs(doc_id, text) → one row per row of docs: doc_id, copy_id (least
    doc_id with the same words), n_copies, class_id (least doc_id of the linked
    group), n_links (different texts linked to this one).

    Texts are read twice: once for their paths, once (members of candidate
    groups only go on) for the exact shingles.
    """
    rows, cls = _joined(docs, threshold)
    cls = cls.select(F.col("c1").alias("_c1"), F.col("c2").alias("_c2"), F.col("class_id").alias("copy_id"), "n_copies",
                     F.col("least").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return (rows.select("doc_id", "c1", "c2").join(cls, (F.col("c1") == F.col("_c1")) & (F.col("c2") == F.col("_c2")))
            .select("doc_id", "copy_id", "n_copies", "class_id", "n_links"))


def _joined(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, fingerprint, class) and the classes with their linked
    group: root, least (its least doc_id), kept (the row that stands for it)."""
    ready(docs.sparkSession)
    docs = docs.select("doc_id", "text", *[f.alias(n) for n, f in zip(("f1", "f2"), fingerprint(F.col("text")), strict=True)])
    id_type = dict(docs.dtypes)["doc_id"]
    rows = stored(docs.mapInArrow(
        _paths, f"doc_id {id_type}, f1 long, f2 long, c1 long, c2 long, n_words long, path array<long>"), "near-rows")
    cls = stored(rows.groupBy("c1", "c2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "f1", "f2")).alias("row"),
        F.count(F.lit(1)).alias("n_copies"), F.any_value("path").alias("path"))
        .withColumn("class_id", F.col("row.doc_id")).withColumn("node", F.col("c1")), "near-nodes")
    leaves = cls.select("node", F.explode("path").alias("prefix"))  # the prefix hash names its tree
    bucket = stored(leaves.groupBy("prefix").agg(F.min("node").alias("b"), F.max("node").alias("_max"))
                    .filter("b < _max").drop("_max"), "near-buckets")
    group = components(leaves.join(bucket, "prefix").select(F.col("node").alias("a"), "b"), "near-candidates")
    group = group.join(group.groupBy("root").agg(F.count(F.lit(1)).alias("g")), "root")
    members = stored(cls.select("node", "row").join(group, "node")
                     .select("node", "root", F.ceil(F.col("g") / BLOCK).cast("int").alias("blocks"),
                             F.col("row.doc_id").alias("_id"), F.col("row.f1").alias("_f1"), F.col("row.f2").alias("_f2")),
                     "near-groups")
    # a merge join at every size: members grow with the corpus, texts are dealt once
    texts = (docs.join(members.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id"))
                       & (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2")))
             .select("node", "root", "blocks", "text"))
    met = (texts.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")))
    checked = stored(met.select("root", "bi", "bj", "node", "block", "text").groupBy("root", "bi", "bj")
                     .applyInPandas(_verify(threshold), "node long, root long, links long"), "near-verified")
    links = checked.groupBy("node").agg(F.sum("links").alias("n_links"))
    linked = components(checked.select(F.col("node").alias("a"), F.col("root").alias("b")), "near-linked")
    cls = (cls.drop("path").join(links, "node", "left").join(linked, "node", "left")
           .withColumn("root", F.coalesce("root", "node")))
    group = cls.groupBy("root").agg(F.min("class_id").alias("least"), F.min("row").alias("kept"))
    return rows.drop("path"), cls.join(group, "root")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each linked group (of its least doc_id, once).

    The row that stands for a group is named by doc_id and the fingerprint of
    its text.  A merge join at every size, on a key without nulls: its
    partitions serve the last step too, so texts are dealt once.
    """
    key, names = lambda c: F.coalesce(c.cast("string"), F.lit("\0")), ["_near_key", "_near_f1", "_near_f2"]
    kept = [F.col(f"kept.{c}") for c in ("doc_id", "f1", "f2")]
    keep = stored(_joined(docs, threshold)[1].select(*[c.alias(n) for n, c in zip(names, (key(kept[0]), *kept[1:]), strict=True)])
                  .distinct(), "near-kept")
    own = [c.alias(n) for n, c in zip(names, (key(F.col("doc_id")), *fingerprint(F.col("text"))), strict=True)]
    out = packed(docs, *own).join(keep.hint("merge"), names, "left_semi")
    return out.dropDuplicates(names).select("doc.*")
