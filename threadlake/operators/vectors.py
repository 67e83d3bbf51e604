"""Vectors: embedding (V1), exact search (V3) and similarity join (V5, J6), LSH
variant, recency / complexity scores (V6, V7).

* Search sends blocks of queries to the vectors (``knn``): no vector moves.
* The similarity join is a radius join by metric partitioning
  (``similar_pairs``): cells around pivots, triangle-inequality bounds, blocks
  inside large cells, copies of a vector counted as one.
* ``block_similarity`` compares two sides block by block, for more queries than
  can be sent, and for radii that cells do not help with.  No task holds more than
  ``chunk × chunk`` scores, and only rows that pass the threshold and the local
  top-k leave a task.
"""

from __future__ import annotations

import math

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlake.functions.vector import normalize
from threadlake.session import cut_lineage

KEY = ["session_id", "turn_idx"]

# Fixed hybrid-score values.
W_SEMANTIC, W_RECENCY, W_COMPLEXITY = 0.7, 0.2, 0.1
RECENCY_DAYS = 365
COMPLEXITY_TURNS = 50
UNKNOWN_RECENCY = 0.5


# --- scores ---------------------------------------------------------------------

def recency(started_at: Column, as_of: Column) -> Column:
    """V6: 1 − floor(age days)/365 clamped to [0, 1]; 0.5 when missing or
    unparsable."""
    ts = F.try_to_timestamp(started_at)
    secs = F.unix_timestamp(as_of) - F.unix_timestamp(ts)
    days = F.greatest(F.lit(0), F.floor(secs / 86400))
    return F.when(ts.isNull(), F.lit(UNKNOWN_RECENCY)).otherwise(
        F.greatest(F.lit(0.0), F.lit(1.0) - days / F.lit(float(RECENCY_DAYS))))


def complexity(turn_count: Column) -> Column:
    """V7: min(1, turn_count / 50)."""
    return F.least(F.lit(1.0), F.coalesce(turn_count, F.lit(0)) / F.lit(float(COMPLEXITY_TURNS)))


def hybrid(cos: Column, rec: Column, cplx: Column) -> Column:
    return F.lit(W_SEMANTIC) * cos + F.lit(W_RECENCY) * rec + F.lit(W_COMPLEXITY) * cplx


# --- V1 ------------------------------------------------------------------------------

def hashing_model(dims: int = 384):
    """Stand-in encoder for tests: signed feature hashing of lower-cased words,
    L2-normalised.  Any callable ``list[str] -> ndarray[n, dims]`` can replace
    it (e.g. a sentence encoder loaded once per Python worker)."""
    import re

    import xxhash

    word = re.compile(r"\w+", re.UNICODE)

    def encode(texts):
        out = np.zeros((len(texts), dims), dtype=np.float32)
        for i, t in enumerate(texts):
            for w in word.findall((t or "").lower()):
                h = xxhash.xxh64_intdigest(w)
                out[i, h % dims] += 1.0 if (h >> 63) & 1 else -1.0
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n == 0, 1, n)

    return encode


MAX_CHARS = 512  # fixed: what the encoder sees of a turn


def text_hash(text: Column, max_chars: int | None = MAX_CHARS) -> Column:
    """SHA-256 of what the encoder sees of a text."""
    return F.sha2(F.encode(text if max_chars is None else F.substring(text, 1, max_chars), "UTF-8"), 256)


def embed_turns(turns: DataFrame, existing: DataFrame | None = None, make_model=None,
                dims: int = 384, batch_size: int = 128, max_chars: int | None = MAX_CHARS) -> DataFrame:
    """V1: embed embeddable turns that have no vector yet (J4 anti join), or one
    of another text: ``existing`` vectors with a ``text_hash`` count for that text
    only, those without for their turn.

    The model runs through ``predict_batch_udf``: Arrow batches of
    ``batch_size`` texts, model built once per Python worker.  The model sees the
    first ``max_chars`` characters of a turn (None: all of them).  Output:
    session_id, turn_idx, embedding, text_hash.
    """
    from pyspark.ml.functions import predict_batch_udf

    from threadlake.operators.sessions import embeddable

    make_model = make_model or (lambda: hashing_model(dims))

    def make_predict_fn():
        model = make_model()

        def predict(texts: np.ndarray) -> np.ndarray:
            return np.asarray(model(list(texts)), dtype=np.float32)
        return predict

    enc = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size)
    todo = turns.filter(embeddable()).withColumn("text_hash", text_hash(F.col("text"), max_chars))
    if existing is not None:
        known = [*KEY, "text_hash"] if "text_hash" in existing.columns else KEY
        todo = todo.join(existing.select(*known), known, "left_anti")
    text = F.col("text") if max_chars is None else F.substring("text", 1, max_chars)
    emb = todo.select(*KEY, enc(text).alias("embedding"), "text_hash")
    return emb.select(*KEY, normalize(F.col("embedding")).alias("embedding"), "text_hash")


def refresh_vectors(turns: DataFrame, existing: DataFrame, make_model=None, dims: int = 384, batch_size: int = 128,
                    max_chars: int | None = MAX_CHARS) -> DataFrame:
    """The vector table of ``turns`` as they are: vectors of unchanged texts stay,
    changed and new texts are embedded, vectors without an embeddable turn go."""
    from threadlake.operators.sessions import embeddable

    now = turns.filter(embeddable()).select(*KEY, text_hash(F.col("text"), max_chars).alias("text_hash"))
    kept = existing.join(now, [*KEY, "text_hash"], "left_semi").select(*KEY, "embedding", "text_hash")
    return kept.unionByName(embed_turns(turns, existing, make_model, dims, batch_size, max_chars))


# --- blocked exact similarity ------------------------------------------------------------

_PAIR_SCHEMA = T.StructType([
    T.StructField("l_session_id", T.StringType()), T.StructField("l_turn_idx", T.IntegerType()),
    T.StructField("r_session_id", T.StringType()), T.StructField("r_turn_idx", T.IntegerType()),
    T.StructField("cos", T.DoubleType())])
_PAIR_COLS = [f.name for f in _PAIR_SCHEMA.fields]


def _block_scorer(k: int | None, threshold: float | None):
    def score(l_pdf: pd.DataFrame, r_pdf: pd.DataFrame) -> pd.DataFrame:
        if l_pdf.empty or r_pdf.empty:
            return pd.DataFrame({c: pd.Series([], dtype=t) for c, t in
                                 zip(_PAIR_COLS, ["object", "int32", "object", "int32", "float64"])})
        L = np.stack(l_pdf["vec"].to_numpy()).astype(np.float64)
        R = np.stack(r_pdf["vec"].to_numpy()).astype(np.float64)
        # squared distance by expansion, only to pick candidates
        d2 = (L * L).sum(1)[:, None] + (R * R).sum(1)[None, :] - 2.0 * (L @ R.T)
        approx = 1.0 - d2 / 2.0
        keep = np.ones_like(approx, dtype=bool) if threshold is None else approx >= threshold - 1e-9
        if k is not None and R.shape[0] > k:
            # k-th best per row, ties kept (the exact cut happens after the merge)
            kth = -np.partition(-np.where(keep, approx, -np.inf), k - 1, axis=1)[:, k - 1]
            keep &= approx >= (kth - 1e-9)[:, None]
        li, ri = np.nonzero(keep)
        # exact squared distance for the survivors, summed in float64
        exact = ((L[li] - R[ri]) ** 2).sum(1)
        if threshold is not None:  # the expansion above is only good to 1e-9
            ok = 1.0 - exact / 2.0 >= threshold
            li, ri, exact = li[ok], ri[ok], exact[ok]
        return pd.DataFrame({
            "l_session_id": l_pdf["sid"].to_numpy()[li], "l_turn_idx": l_pdf["tid"].to_numpy()[li].astype("int32"),
            "r_session_id": r_pdf["sid"].to_numpy()[ri], "r_turn_idx": r_pdf["tid"].to_numpy()[ri].astype("int32"),
            "cos": 1.0 - exact / 2.0})
    return score


def _blocks(n: int, chunk: int) -> int:
    return max(1, math.ceil(n / chunk))


def block_similarity(left: DataFrame, right: DataFrame, k: int | None,
                     threshold: float | None = None, chunk: int = 2048) -> DataFrame:
    """Candidate pairs between left(sid, tid, vec) and right(sid, tid, vec):
    for every left row its best-k right rows (ties at the k-th kept) with
    cos ≥ threshold → (l_session_id, l_turn_idx, r_session_id, r_turn_idx, cos).

    The block of a row is a hash of its key; the hash only spreads rows, the
    exact keys travel with the vectors."""
    n_l, n_r = left.count(), right.count()   # two scalars size the blocks
    # at least ~sqrt(cores) blocks per side so that small inputs still spread
    # over the cluster; large inputs are sized by ``chunk``
    spread_min = max(1, math.isqrt(left.sparkSession.sparkContext.defaultParallelism))
    bl = max(_blocks(n_l, chunk), min(spread_min, max(1, n_l // 64)))
    br = max(_blocks(n_r, chunk), min(spread_min, max(1, n_r // 64)))
    # both keys int on both sides: an int and a long of one value hash apart
    lh = F.pmod(F.xxhash64("l.sid", "l.tid"), F.lit(bl)).cast("int")
    rh = F.pmod(F.xxhash64("r.sid", "r.tid"), F.lit(br)).cast("int")
    lrep = left.alias("l").select(*[F.col(f"l.{c}").alias(c) for c in ("sid", "tid", "vec")], lh.alias("bl"),
                                  F.explode(F.sequence(F.lit(0), F.lit(br - 1))).alias("br"))
    rrep = right.alias("r").select(*[F.col(f"r.{c}").alias(c) for c in ("sid", "tid", "vec")], rh.alias("br"),
                                   F.explode(F.sequence(F.lit(0), F.lit(bl - 1))).alias("bl"))
    return (lrep.groupBy("bl", "br").cogroup(rrep.groupBy("bl", "br"))
            .applyInPandas(_block_scorer(k, threshold), _PAIR_SCHEMA))


def _side(vecs: DataFrame) -> DataFrame:
    return vecs.select(F.col("session_id").alias("sid"), F.col("turn_idx").cast("int").alias("tid"),
                       F.col("embedding").alias("vec"))


#: Queries that are sent to the vectors at a time, and how many such passes are
#: made; more queries are joined block by block.
QUERY_BLOCK, PASSES = 4096, 8
#: Scores that a task holds at a time.
SCORES = 4_000_000


def _nearest_in_task(ids: list[int], q: np.ndarray, k: int):
    """Arrow batches of (sid, tid, vec) to this task's best k of every query
    (ties at the k-th kept)."""
    norms = (q * q).sum(1)
    rows = max(1, SCORES // max(1, len(ids)))

    def run(batches):
        at, cos = np.zeros(0, np.int64), np.zeros(0)
        keys: list = []
        least = np.full(len(ids), -np.inf)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                b = batch.slice(start, rows)
                v = np.array(b.column(2).to_pylist(), np.float64)
                # by expansion only to pick candidates
                approx = 1.0 - (norms[:, None] + (v * v).sum(1)[None, :] - 2.0 * (q @ v.T)) / 2.0
                cut = least
                if len(v) > k:
                    cut = np.maximum(cut, np.partition(approx, len(v) - k, axis=1)[:, len(v) - k])
                qi, vi = np.nonzero(approx >= cut[:, None] - 2e-9)
                exact = 1.0 - ((q[qi] - v[vi]) ** 2).sum(1) / 2.0
                sids, tids = b.column(0).to_pylist(), b.column(1).to_pylist()
                at, cos = np.concatenate([at, qi]), np.concatenate([cos, exact])
                keys += [(sids[i], tids[i]) for i in vi.tolist()]
                order = np.lexsort((-cos, at))
                first = np.searchsorted(at[order], np.arange(len(ids)))
                kth = np.full(len(ids), -np.inf)
                full = np.bincount(at, minlength=len(ids)) >= k
                kth[full] = cos[order][first[full] + k - 1]
                least = kth
                stay = order[cos[order] >= kth[at[order]] - 2e-9]
                at, cos, keys = at[stay], cos[stay], [keys[i] for i in stay.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i in at.tolist()], pa.int64()), pa.array([s for s, _ in keys], pa.string()),
             pa.array([t for _, t in keys], pa.int32()), pa.array(cos)], ["query_id", "session_id", "turn_idx", "cos"])
    return run


def knn(queries: DataFrame, vecs: DataFrame, k: int, chunk: int = 2048, block: int = QUERY_BLOCK) -> DataFrame:
    """V3: exact k nearest vectors per query.

    queries(query_id BIGINT, qvec) × vecs(session_id, turn_idx, embedding) →
    (query_id, session_id, turn_idx, distance, cos, knn_rank).

    The vectors stay where they lie: blocks of at most ``block`` queries are
    sent to every task, which keeps its best k of each, and only these meet in a
    shuffle.  Beyond ``PASSES`` blocks both sides are dealt in blocks instead."""
    side = _side(vecs)
    queries = queries.select(F.col("query_id").cast("long"), F.col("qvec").cast("array<double>").alias("qvec"))
    n = queries.count()
    if n <= block * PASSES:
        hits = None
        blocks = max(1, math.ceil(n / block))
        for b in range(blocks):
            some = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).collect()  # about ``block`` rows
            if some:
                fn = _nearest_in_task([r[0] for r in some], np.array([r[1] for r in some], np.float64), k)
                got = side.mapInArrow(fn, "query_id long, session_id string, turn_idx int, cos double")
                hits = got if hits is None else hits.unionByName(got)
        if hits is None:
            hits = queries.select("query_id", F.lit("").alias("session_id"), F.lit(0).alias("turn_idx"), F.lit(0.0).alias("cos"))
    else:
        q = queries.select(F.col("query_id").cast("string").alias("sid"), F.lit(0).alias("tid"), F.col("qvec").alias("vec"))
        hits = block_similarity(q, side, k, None, chunk).select(
            F.col("l_session_id").cast("long").alias("query_id"), F.col("r_session_id").alias("session_id"),
            F.col("r_turn_idx").alias("turn_idx"), "cos")
    w = Window.partitionBy("query_id").orderBy(F.round("cos", 9).desc(), "session_id", "turn_idx")
    out = hits.withColumn("knn_rank", F.row_number().over(w)).filter(F.col("knn_rank") <= k)
    return out.select("query_id", "session_id", "turn_idx",
                      F.sqrt(F.greatest(F.lit(0.0), (1.0 - F.col("cos")) * 2.0)).alias("distance"), "cos", "knn_rank")


# --- metric partitioning (V5, J6) --------------------------------------------------------

#: Pivots at most, and sampled vectors per pivot.
PIVOTS, PER_PIVOT = 256, 8
#: Share of all pairs from which cells do not pay.
WORTH = 0.5
#: Vectors of a block on either side of the join, scores that its task holds at a
#: time, and numbers that leave a task in one batch.
BLOCK, PART, SEND = 32_768, 1_000_000, 2_000_000
SLACK = 1e-6  # of bounds against rounding
#: Pairs that share an LSH bucket, as a share of all, up to which they are joined by it.
SELECTIVE = 0.02


def distinct_vectors(vecs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(rows, vectors): every row's (sid, tid) with the id of its vector, and
    each different vector once with its first k + 1 rows.  Of equal vectors no
    more than these can be among anyone's k nearest, so a group of copies, however
    large, takes part as one vector."""
    side = _side(vecs).withColumn("vec", F.col("vec").cast("array<double>"))
    side = side.withColumn("vid", F.struct(F.xxhash64("vec").alias("a"), F.xxhash64(F.lit("second"), "vec").alias("b")))
    w = Window.partitionBy("vid").orderBy("sid", "tid")
    few = side.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k + 1)
    vectors = few.groupBy("vid").agg(F.first("vec").alias("vec"), F.array_sort(F.collect_list(F.struct("sid", "tid"))).alias("rows"))
    return side.select("vid", "sid", "tid"), vectors


def choose_pivots(vectors: DataFrame, n: int, most: int = PIVOTS) -> np.ndarray:
    """Vectors far from one another, from a sample of fixed size."""
    want = min(most, math.isqrt(n))
    sample = vectors.orderBy(F.xxhash64("vid.b", "vid.a"), "vid").limit(PER_PIVOT * want).select("vec").collect()
    x = np.array([r[0] for r in sample], np.float64)
    chosen, away = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < want and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def _matrix(column) -> np.ndarray:
    """A list column as rows of numbers, without a Python object for each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    if n and not column.null_count:
        size = column.value_lengths().to_numpy(zero_copy_only=False)
        if size[0] and (size == size[0]).all():
            return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    return np.array(column.to_pylist(), np.float64)


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d2 = (v * v).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2.0 * (v @ pivots.T)
    return np.sqrt(np.maximum(d2, 0.0))


@dataclass
class Cells:
    """A partition of the vectors: ``members`` (vid, vec, cell, away) once each,
    ``reach`` the cells in whose radius they may lie, own cell included.
    ``stats``: cell -> (members, reaching, radius); at most ``PIVOTS`` entries."""
    members: DataFrame
    reach: DataFrame
    stats: dict[int, tuple[int, int, float]]

    @property
    def comparisons(self) -> int:
        """Pairs that the join looks at, at most."""
        return sum(m * r for m, r, _ in self.stats.values())


def _sent(b: pa.RecordBatch, d: np.ndarray, ok: np.ndarray):
    """A row for every cell that a vector of a batch reaches, in batches of at
    most ``SEND`` numbers: a wide radius reaches nearly all cells."""
    row, cell = np.nonzero(ok)
    step = max(1, SEND // max(1, len(b.column(1)[0])))
    for s in range(0, len(row), step):
        at, to = row[s:s + step], cell[s:s + step]
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)),
                                          pa.array(to, pa.int32()), pa.array(d[at, to])], ["vid", "vec", "cell", "away"])


def cells_of(vectors: DataFrame, n: int, radius: float) -> Cells:
    """Cells around pivots.  For x in the cell of p and any y within ``radius``:
    |y - p| <= the cell's radius + ``radius``, and, as x is nearer to p than to
    the pivot q of y's own cell, |y - p| - |y - q| <= 2 * ``radius``.  Cells that
    fail a bound hold no partner of y."""
    pivots = choose_pivots(vectors, n)

    def home(batches):
        for b in batches:
            if b.num_rows:
                d = _distances(_matrix(b.column(1)), pivots)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell, pa.int32()),
                                                  pa.array(d[np.arange(len(d)), cell])], ["vid", "vec", "cell", "away"])

    kind = "vid struct<a:bigint,b:bigint>, vec array<double>"
    members = cut_lineage(vectors.select("vid", "vec").mapInArrow(home, f"{kind}, cell int, away double"))
    sizes = {r[0]: (r[1], r[2]) for r in members.groupBy("cell").agg(F.count(F.lit(1)), F.max("away")).collect()}
    reached = np.full(len(pivots), -np.inf)
    for c, (_, far) in sizes.items():
        reached[c] = far + radius + SLACK

    def within(b):
        """Distances of a batch from the pivots, and which cells it may reach."""
        d = _distances(_matrix(b.column(1)), pivots)
        own = b.column(2).to_numpy()
        ok = (d <= reached) & (d - d[np.arange(len(d)), own][:, None] <= 2 * radius + SLACK)
        ok[np.arange(len(d)), own] = True
        return d, ok

    def tally(batches):
        n = np.zeros(len(pivots), np.int64)
        for b in batches:
            if b.num_rows:
                n += within(b)[1].sum(0)
        cell = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(n[cell])], ["cell", "n"])

    def reach(batches):
        for b in batches:
            if b.num_rows:
                d, ok = within(b)
                yield from _sent(b, d, ok)

    # counted without a vector leaving its task: whether cells pay is not known yet
    counts = dict(members.mapInArrow(tally, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect())
    reaching = members.mapInArrow(reach, f"{kind}, cell int, away double")
    return Cells(members, reaching, {c: (m, counts[c], far) for c, (m, far) in sizes.items()})


def _near_scorer(k: int, threshold: float, hashed: bool = False):
    """Pairs of one block of a cell: both sides sorted by their distance from
    the pivot, so each vector meets only those whose distance differs by the
    radius at most.  They meet a part at a time, and what fails the best k so far
    goes at once, so a task holds ``PART`` scores and the best of its rows.  With
    ``hashed`` only vectors that share one of their ``hashes`` are a pair."""
    radius = math.sqrt(max(0.0, 2.0 * (1.0 - threshold)))
    kind = pa.struct([("a", pa.int64()), ("b", pa.int64())])
    least = threshold - 1e-9
    tall = math.isqrt(PART) // 2

    def best(lv, la, rv, ra, lh, rh):
        """(row, column) pairs of a few left rows: the best k of each, ties kept."""
        lo = np.searchsorted(ra, la[0] - radius - SLACK)
        hi = np.searchsorted(ra, la[-1] + radius + SLACK, "right")
        norms, at, to, near = (lv * lv).sum(1), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        floor = np.full(len(lv), least)
        for s in range(lo, hi, 2 * tall * 2):
            w = rv[s:min(hi, s + 2 * tall * 2)]
            approx = 1.0 - (norms[:, None] + (w * w).sum(1)[None, :] - 2.0 * (lv @ w.T)) / 2.0  # only to pick candidates
            keep = approx >= floor[:, None]
            if keep.sum() > keep.size // 20 and len(w) > k:  # many: cut before they are listed
                if hashed:
                    same = np.zeros(keep.shape, bool)
                    for h in range(lh.shape[1]):
                        same |= lh[:, h][:, None] == rh[s:s + len(w), h][None, :]
                    keep &= same
                kth = np.partition(np.where(keep, approx, -np.inf), len(w) - k, axis=1)[:, len(w) - k]
                keep &= approx >= (kth - 2e-9)[:, None]
            i, j = np.nonzero(keep)
            if hashed:
                ok = (lh[i] == rh[s + j]).any(1)
                i, j = i[ok], j[ok]
            if not len(i):
                continue
            at, to, near = np.concatenate([at, i]), np.concatenate([to, s + j]), np.concatenate([near, approx[i, j]])
            order = np.lexsort((-near, at))
            at, to, near = at[order], to[order], near[order]
            full = np.flatnonzero(np.bincount(at, minlength=len(lv)) >= k)
            floor[full] = np.maximum(least, near[np.searchsorted(at, full) + k - 1] - 2e-9)
            stay = near >= floor[at]
            at, to, near = at[stay], to[stay], near[stay]
        d2 = np.concatenate([((lv[at[x:x + tall]] - rv[to[x:x + tall]]) ** 2).sum(1) for x in range(0, len(at), tall)] or [np.zeros(0)])
        cos = 1.0 - d2 / 2.0
        ok = cos >= threshold
        if hashed:
            ok &= np.sqrt(d2) < radius
        return at[ok], to[ok], cos[ok]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            left, right = left.sort_by("away"), right.sort_by("away")
            lv, rv = _matrix(left.column("vec")), _matrix(right.column("vec"))
            la, ra = left.column("away").to_numpy(), right.column("away").to_numpy()
            lh, rh = (_matrix(t.column("hashes")).astype(np.int64) if hashed else None for t in (left, right))
            for s in range(0, len(lv), tall):
                e = s + tall
                i, j, cos = best(lv[s:e], la[s:e], rv, ra, lh[s:e] if hashed else None, rh)
                out.append((s + i, j, cos))
        li, ri, cos = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        ids = lambda t, i: t.column("vid").combine_chunks().cast(kind).take(pa.array(i))
        return pa.table({"l": ids(left, li), "r": ids(right, ri), "cos": pa.array(cos)})
    return score


def _cell_pairs(cells: Cells, k: int, threshold: float, chunk: int, hashed: bool = False) -> DataFrame:
    """(l, r, cos) over the cells; a cell of many vectors is cut into blocks on
    both sides, every pair of blocks being a task's work of bounded size."""
    blocks = {c: (max(1, math.ceil(m / chunk)), max(1, math.ceil(r / chunk))) for c, (m, r, _) in cells.stats.items()}
    table = F.create_map(*[F.lit(x) for c, (a, b) in blocks.items() for x in (c, f"{a},{b}")])
    cut = F.split(table[F.col("cell")], ",")
    a, b = cut[0].cast("int"), cut[1].cast("int")
    part = lambda n: F.pmod(F.xxhash64("vid.b", "vid.a"), n).cast("int")
    # named anew: both sides may be one table
    given = [F.col(c).alias(c) for c in ("vid", "vec", "away", "cell", *(["hashes"] if hashed else []))]
    left = cells.members.select(*given, part(a).alias("i"), F.explode(F.sequence(F.lit(0), b - 1)).alias("j"))
    right = cells.reach.select(*given, part(b).alias("j"), F.explode(F.sequence(F.lit(0), a - 1)).alias("i"))
    return (left.groupBy("cell", "i", "j").cogroup(right.groupBy("cell", "i", "j"))
            .applyInArrow(_near_scorer(k, threshold, hashed), "l struct<a:bigint,b:bigint>, r struct<a:bigint,b:bigint>, cos double"))


def _all_pairs(vectors: DataFrame, n: int, k: int, threshold: float, chunk: int, hashed: bool = False) -> DataFrame:
    """All vectors in one cell: every block meets every block.  A few vectors are
    cut in so many blocks that all cores have work."""
    spread = math.isqrt(4 * vectors.sparkSession.sparkContext.defaultParallelism) + 1
    chunk = max(1, min(chunk, max(math.ceil(n / spread), 256)))
    side = vectors.withColumns({"cell": F.lit(0), "away": F.lit(0.0)})
    return _cell_pairs(Cells(side, side, {0: (n, n, 0.0)}), k, threshold, chunk, hashed)


def similar_pairs(vecs: DataFrame, k: int = 5, threshold: float = 0.85, chunk: int = BLOCK) -> DataFrame:
    """The k nearest other vectors of every vector among those with
    cos ≥ threshold, ties by key.

    Different vectors are joined within the radius that the threshold is, by
    cells around pivots; when the bounds leave more than ``WORTH`` of all pairs
    (a wide radius among vectors without clusters) all are compared block by
    block.  Both give the same rows."""
    rows, vectors = distinct_vectors(vecs, k)
    vectors = cut_lineage(vectors)
    n = vectors.count()
    pairs = None
    if n > 4:
        cells = cells_of(vectors, n, math.sqrt(max(0.0, 2.0 * (1.0 - threshold))))
        if cells.comparisons <= WORTH * n * n:
            pairs = _cell_pairs(cells, k + 1, threshold, chunk)
    if pairs is None:
        pairs = _all_pairs(vectors, n, k + 1, threshold, chunk)
    return _best_rows(rows, vectors, pairs, k)


def _best_of_vectors(vectors: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(vid, best): the first k + 1 rows that a vector meets in pairs (l, r, cos),
    with their rank.  Every vector has a row, so one behind k + 1 others has none
    to give; only the best meet the rows."""
    ahead = Window.partitionBy("l").orderBy(F.round("cos", 9).desc())
    pairs = pairs.withColumn("_ahead", F.rank().over(ahead)).filter(F.col("_ahead") <= k + 1).drop("_ahead")
    target = vectors.select(F.col("vid").alias("r"), F.explode("rows").alias("dst"))
    w = Window.partitionBy("l").orderBy(F.round("cos", 9).desc(), "dst.sid", "dst.tid")
    best = pairs.join(target, "r").withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k + 1)
    return best.groupBy(F.col("l").alias("vid")).agg(F.array_sort(F.collect_list(F.struct("_rank", "dst", "cos", "r"))).alias("best"))


def _best_rows(rows: DataFrame, vectors: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The k best other rows of every row, from pairs of vectors."""
    others = F.filter("best", lambda x: ~((x["dst"]["sid"] == F.col("sid")) & (x["dst"]["tid"] == F.col("tid"))))
    got = rows.join(_best_of_vectors(vectors, pairs, k), "vid").select("sid", "tid", F.explode(F.slice(others, 1, k)).alias("x"))
    return got.select(F.col("sid").alias("src_session_id"), F.col("tid").alias("src_turn_idx"),
                      F.col("x.dst.sid").alias("dst_session_id"), F.col("x.dst.tid").alias("dst_turn_idx"),
                      F.col("x.cos").alias("cos"))


def exclude_temporal(pairs: DataFrame, temporal: DataFrame | None) -> DataFrame:
    """Drop pairs that are TEMPORAL edges in either direction."""
    if temporal is None:
        return pairs
    t = temporal.select("src_session_id", "src_turn_idx", "dst_session_id", "dst_turn_idx")
    both = t.unionByName(t.select(
        F.col("dst_session_id").alias("src_session_id"), F.col("dst_turn_idx").alias("src_turn_idx"),
        F.col("src_session_id").alias("dst_session_id"), F.col("src_turn_idx").alias("dst_turn_idx")))
    return pairs.join(both, ["src_session_id", "src_turn_idx", "dst_session_id", "dst_turn_idx"], "left_anti")


def wire_similar(vecs: DataFrame, temporal: DataFrame | None = None, k: int = 5,
                 threshold: float = 0.85, chunk: int = BLOCK) -> DataFrame:
    """V5: directed SIMILAR_TO edges, TEMPORAL pairs (either direction)
    excluded (J5), weight = round(cos, 6).  Full rebuild."""
    p = exclude_temporal(similar_pairs(vecs, k, threshold, chunk), temporal)
    return p.select("src_session_id", "src_turn_idx", "dst_session_id", "dst_turn_idx",
                    F.lit("SIMILAR_TO").alias("edge_type"), F.round("cos", 6).alias("weight"))


def wire_similar_lsh(vecs: DataFrame, temporal: DataFrame | None = None, k: int = 5,
                     threshold: float = 0.85,
                     bucket_length: float = 0.6, num_tables: int = 6) -> DataFrame:
    """V5 approximate variant: random-projection LSH radius join
    (L2 ≤ sqrt(2·(1−threshold))), then the same top-(k+1) rule.  Recall is not
    guaranteed; its output is a subset of the exact edges."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    # a row counts once, copies of a vector share all their buckets
    rows, vectors = distinct_vectors(vecs.select(*KEY, "embedding").distinct(), k)
    v = cut_lineage(vectors.withColumn("features", array_to_vector("vec")))
    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes",
                                      bucketLength=bucket_length, numHashTables=num_tables, seed=7)
    model = lsh.fit(v)
    radius = math.sqrt(max(0.0, 2.0 * (1.0 - threshold)))
    marked = cut_lineage(model.transform(v).select("vid", "vec", F.transform(
        "hashes", lambda h: vector_to_array(h)[0].cast("long")).alias("hashes")))
    n = marked.count()
    met = (marked.select(F.posexplode("hashes").alias("table", "bucket")).groupBy("table", "bucket").count()
           .agg(F.sum(F.col("count").cast("double") * F.col("count"))).first()[0] or 0.0)
    if met <= SELECTIVE * n * n:  # small buckets: joined by bucket
        j = model.approxSimilarityJoin(v, v, radius, distCol="dist")
        pairs = j.select(F.col("datasetA.vid").alias("l"), F.col("datasetB.vid").alias("r"),
                         (1.0 - F.col("dist") * F.col("dist") / 2.0).alias("cos")).filter(F.col("cos") >= threshold)
    else:  # buckets that hold a good part of all vectors: block by block, those of one bucket count
        pairs = _all_pairs(marked, n, k + 1, threshold, BLOCK, hashed=True)
    # ranked by turn, whichever vector of it a pair has; its own rows come first
    src = [F.col("sid").alias("src_session_id"), F.col("tid").alias("src_turn_idx")]
    met = rows.join(_best_of_vectors(v, pairs, k), "vid").select("vid", "sid", "tid", F.explode("best").alias("x"))
    met = met.filter(~((F.col("x.r") == F.col("vid")) & (F.col("x.dst.sid") == F.col("sid")) & (F.col("x.dst.tid") == F.col("tid"))))
    p = met.select(*src, F.col("x.dst.sid").alias("dst_session_id"), F.col("x.dst.tid").alias("dst_turn_idx"), F.col("x.cos").alias("cos"))
    p = p.unionByName(rows.select(*src, F.col("sid").alias("dst_session_id"), F.col("tid").alias("dst_turn_idx"), F.lit(1.0).alias("cos")))
    is_self = (F.col("src_session_id") == F.col("dst_session_id")) & (F.col("src_turn_idx") == F.col("dst_turn_idx"))
    w = Window.partitionBy("src_session_id", "src_turn_idx").orderBy(
        F.round("cos", 9).desc(), (~is_self).cast("int"), "dst_session_id", "dst_turn_idx")
    r = p.withColumn("_rank", F.row_number().over(w))
    r = exclude_temporal(r.filter((F.col("_rank") <= k + 1) & ~is_self), temporal)
    return r.select("src_session_id", "src_turn_idx", "dst_session_id", "dst_turn_idx",
                    F.lit("SIMILAR_TO").alias("edge_type"), F.round("cos", 6).alias("weight"))


def centroids(df: DataFrame, group: str, vec: str) -> DataFrame:
    """Per-group mean vector, normalised: (group, qvec).  Aggregated per
    (group, dimension), so no group is collected whole."""
    e = df.select(group, F.posexplode(vec).alias("d", "x"))
    m = e.groupBy(group, "d").agg(F.avg(F.col("x").cast("double")).alias("m"))
    arr = m.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("d", "m"))).alias("s"))
    return arr.select(group, normalize(F.transform("s", lambda x: x["m"])).alias("qvec"))
