"""Embedding whitening by spectral divide and conquer.

``grid`` turns every embedding into whole numbers; the fit list holds each
distinct vector once, so copies, however many, do not pull the components.
Spark counts and sums the list and adds up the products of the vectors, taken
around the whole numbers next to their means: exact sums of small integers, alike
in any order of tasks.  What reaches the driver is the d x d covariance.

``components`` splits it: the orthogonal polar factor of the covariance minus a
shift (QDWH: Halley steps with weights that follow the least singular value,
done by QR factorisations until they are tame) gives the projector on the
eigenvectors above the shift; bases of its range and of the rest are invariant
subspaces, which are split again until one dimension, or one eigenvalue, is
left.  Subspaces that hold none of the wanted components are not split.

``whiten`` carries the d x k matrix of components to the rows.

Defined cases: a vector that is null or holds a null, a NaN or an infinity is
dropped, as is one shorter than the longest whole vector (its missing entries
count as null); repeated vectors and ids all get their rows; a component whose
variance is zero to double precision cannot be scaled and is left out, so fewer
distinct vectors than dimensions give fewer components, one distinct vector
none; equal eigenvalues get any orthonormal basis of their space, the same for
all rows; a deviation that does not fit a long is null; an empty table gives no
row.  Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import ready, stored

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
EPS = np.finfo(float).eps


# --- small dense algebra (d x d) -------------------------------------------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH."""
    n = len(a)
    x = a / (np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf)) or 1.0)
    diagonal = np.abs(np.diag(np.linalg.qr(x, mode="r")))
    low = min(1.0, max(diagonal.min() / np.sqrt(n), EPS / n))  # below the least singular value, or near it
    one = np.eye(n)
    for _ in range(40):
        square = low * low
        d = (4 * max(0.0, 1 - square) / square ** 2) ** (1 / 3)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, one]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        else:
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(one + wc * x.T @ x, x.T).T
        new = (new + new.T) / 2
        step, x = np.linalg.norm(new - x), new
        if step <= 4 * EPS ** (1 / 3) and abs(1 - low) < 10 * EPS and np.linalg.norm(x @ x - one) < 1e-12 * n:
            break
    return x


def split(a: np.ndarray, scale: float) -> tuple[np.ndarray, int] | None:
    """An orthonormal basis whose first k columns span the eigenvectors of ``a``
    above some shift inside its spectrum, the others the rest; None when ``a``
    has one eigenvalue to double precision."""
    n, mean = len(a), np.trace(a) / len(a)
    spread = np.linalg.norm(a - mean * np.eye(n))
    if spread <= 4 * n * EPS * scale:
        return None
    diagonal = np.sort(np.diag(a))
    start = np.random.default_rng(n).standard_normal((n, n))
    best = None
    # the mean always lies inside the spectrum; steps off it when it is an eigenvalue
    for shift in (np.median(diagonal), mean, *(mean + spread * s / n for s in (0.01, -0.013, 0.1, -0.13, 0.31, -0.37))):
        u = polar(a - shift * np.eye(n))
        p = (u + np.eye(n)) / 2
        k = round(np.trace(p))
        if not 0 < k < n:
            continue
        q, _ = np.linalg.qr(p @ start)
        q1 = q[:, :k]
        for _ in range(2):
            q1, _ = np.linalg.qr(p @ q1)
        rest = start[:, :n - k] - p @ start[:, :n - k]
        for _ in range(2):
            rest -= q1 @ (q1.T @ rest)
            rest, _ = np.linalg.qr(rest)
        off = np.linalg.norm(rest.T @ a @ q1)
        if best is None or off < best[0]:
            best = off, np.hstack([q1, rest]), k
        if off <= 16 * n * EPS * scale:
            break
    return best and best[1:]


def components(cov: np.ndarray, want: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenvalues, falling, and their unit eigenvectors
    (columns), without those of no variance."""
    scale = float(np.linalg.norm(cov))
    values, vectors = [], []

    def descend(basis: np.ndarray) -> None:
        """Collect the components in the span of ``basis``, largest first."""
        if len(values) >= want:
            return
        a = basis.T @ cov @ basis
        a = (a + a.T) / 2
        halves = split(a, scale) if len(a) > 1 else None
        if halves is None:
            for i in range(len(a)):
                values.append(a[i, i])
                vectors.append(basis[:, i])
            return
        q, k = halves
        for part in (basis @ q[:, :k], basis @ q[:, k:]):
            descend(np.linalg.qr(part)[0])

    if scale > 0:
        descend(np.eye(len(cov)))
    order = sorted(range(len(values)), key=lambda i: -values[i])[:want]
    order = [i for i in order if values[i] > 4 * len(cov) * EPS * scale]
    return (np.array([values[i] for i in order]),
            np.array([vectors[i] for i in order]).T if order else np.zeros((len(cov), 0)))


# --- Spark -----------------------------------------------------------------------------------

def grid(embeddings: DataFrame) -> DataFrame:
    """vec_id, x: the whole vectors as longs."""
    whole = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long") + F.lit(OFFSET))
    rows = embeddings.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & whole)
    return rows.select("vec_id", x.alias("x"))


def _matrix(x: pa.Array, dims: int) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), dims)


def _summed(df: DataFrame, dims: int, width: int, of) -> np.ndarray:
    """Sum over all rows of the Gram matrices of ``of(x)``: one per task, added
    up by Spark entry by entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            if b.num_rows:
                y = of(_matrix(b.column(0), dims))
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total))], ["i", "row"])

    parts = df.select("x").mapInArrow(run, "i int, row array<double>")
    sums = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for i, j, v in sums.collect():  # width x width, whatever the number of rows
        out[i, j] = v
    return out


@dataclass
class Whitening:
    """What the fit gives: sizes do not depend on the number of rows."""
    n: int
    dims: int
    sums: list[int]
    middle: np.ndarray      # whole numbers next to the means
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.middle).astype(float) - self.shift

    @property
    def shift(self) -> np.ndarray:
        return np.array([s - self.n * int(m) for s, m in zip(self.sums, self.middle, strict=True)], float) / self.n

    def transform(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, want: int = COMPONENTS) -> Whitening | None:
    """Whitening of ``grid`` rows, or None without any."""
    distinct = stored(rows.select("x").distinct(), "whiten-fit")
    per = distinct.select(F.size("x").alias("d"), F.posexplode("x").alias("i", "v")).groupBy("d", "i")
    sums = per.agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    if not sums:
        return None
    dims = max(r["d"] for r in sums)
    sums = sorted((r["i"], int(r["s"]), r["n"]) for r in sums if r["d"] == dims)
    n, total = sums[0][2], [s for _, s, _ in sums]
    w = Whitening(n, dims, total, np.array([(2 * s + n) // (2 * n) for s in total], np.int64),
                  np.zeros(0), np.zeros((dims, 0)), 0.0, 0.0)
    distinct = distinct.filter(F.size("x") == dims)
    middle, shift = w.middle, w.shift
    products = _summed(distinct, dims, dims, lambda x: (x - middle).astype(float))
    cov = products / n - np.outer(shift, shift)
    w.values, w.vectors = components((cov + cov.T) / 2, want)
    w.trace = float(np.trace(cov))
    k = len(w.values)
    if k:
        # the last column counts: with it the Gram matrix holds the sums too
        got = _summed(distinct, dims, k + 1, lambda x: np.hstack([w.transform(x), np.ones((len(x), 1))]))
        mean = got[:k, k] / n
        w.identity_error = float(np.abs(got[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max())
    return w


def whiten(embeddings: DataFrame, want: int = COMPONENTS) -> DataFrame:
    """embeddings(vec_id, embedding) to vec_id, n, deviation, whitened (array),
    explained (array), identity_error: one row per whole vector."""
    ready(embeddings.sparkSession)
    rows = grid(embeddings)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    out = f"vec_id {kind}, deviation long, whitened array<double>"
    w = fit(rows, want)
    if w is None:
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
    dims, left = w.dims, np.array([s - w.n * int(m) for s, m in zip(w.sums, w.middle, strict=True)], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1), dims)
            away = w.n * (x - w.middle) - left      # n * x - sums, in 64 bits
            fits = (away.astype(float) ** 2).sum(1) < 2.0 ** 63
            dev = pa.array((away * away).sum(1), mask=~fits)
            yield pa.RecordBatch.from_arrays([b.column(0), dev, pa.array(list(w.transform(x)), pa.list_(pa.float64()))],
                                             ["vec_id", "deviation", "whitened"])

    got = rows.filter(F.size("x") == dims).mapInArrow(run, out)
    explained = F.array(*[F.lit(float(e / w.trace)) for e in w.values]).cast("array<double>")
    return got.select("vec_id", F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
                      explained.alias("explained"), F.lit(w.identity_error).alias("identity_error"))


def by_component(whitened: DataFrame) -> DataFrame:
    """One row per vector and component."""
    x = whitened.select("vec_id", "n", "deviation", "explained", "identity_error",
                        F.posexplode("whitened").alias("c", "whitened"))
    return x.select("vec_id", (F.col("c") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                    F.col("explained")[F.col("c")].alias("explained"), "identity_error")
