"""Whitening against numpy's eigensolver and exact integer sums."""

import math

import numpy as np
import pytest

from conftest import SF_MID, SF_SMALL
from threadlake.llm import whiten as W
from threadlake.llm.common import table


def spectra():
    rng = np.random.default_rng(3)
    yield np.diag([5.0, 3.0, 1.0, 0.5])
    yield np.eye(6) * 2
    yield np.zeros((3, 3))
    for values in (rng.random(40), np.r_[100.0, np.ones(20), np.zeros(10)], 10.0 ** -np.arange(12.0), np.arange(9) - 4.0 + 4,
                   np.r_[1.0, 1.0 + 1e-9, 1.0 + 2e-9, 2.0], np.repeat([3.0, 2.0, 1.0], 7)):
        q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
        yield q @ np.diag(values) @ q.T


@pytest.mark.parametrize("a", list(spectra()))
def test_components_are_eigenvectors(a):
    a = (a + a.T) / 2
    values, vectors = W.components(a, len(a))
    want = np.sort(np.linalg.eigvalsh(a))[::-1]
    scale = max(np.linalg.norm(a), 1e-300)
    assert len(values) == (want > 4 * len(a) * W.EPS * scale).sum() or abs(len(values) - (want > 1e-13 * scale).sum()) <= 1
    assert np.allclose(values, want[:len(values)], atol=1e-12 * scale, rtol=0)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-12 * scale * len(a)


def test_polar_factor():
    a = np.random.default_rng(1).standard_normal((30, 30))
    a = a + a.T
    u = W.polar(a)
    value, vector = np.linalg.eigh(a)
    assert np.allclose(u, vector @ np.diag(np.sign(value)) @ vector.T, atol=1e-11)


def reference(rows):
    """vec_id -> (n, deviation, whitened up to sign), by numpy and Python integers."""
    x = {i: [math.floor(64 * float(c)) + 1000000 for c in v] for i, v in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=object)
    n, s = len(fit), fit.sum(0)
    centred = np.array([[float(n * a - b) / n for a, b in zip(v, s)] for v in fit])
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1][:16], vector[:, ::-1][:, :16]
    out = {}
    for i, v in x.items():
        away = [n * a - b for a, b in zip(v, s)]
        out[i] = n, sum(a * a for a in away), np.array([a / n for a in away]) @ vector / np.sqrt(value)
    return out, value / (centred ** 2).sum() * n


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_registered_query(spark, sf):
    from threadlake.llm.catalog import queries
    got = queries()["op13_embedding_whitening"](spark, sf).toPandas()
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    want, explained = reference(rows)
    assert len(got) == 16 * len(rows) and got["identity_error"].nunique() == 1
    assert got["identity_error"].iloc[0] < 1e-10
    wide = got.pivot(index="vec_id", columns="component", values="whitened")
    ids = list(want)
    mine, theirs = wide.loc[ids].to_numpy(), np.array([want[i][2] for i in ids])
    sign = np.sign((mine * theirs).sum(0))
    assert np.allclose(mine * sign, theirs, atol=1e-7)
    one = got[got["component"] == 1].set_index("vec_id")
    assert all(one.loc[i, "n"] == want[i][0] and one.loc[i, "deviation"] == want[i][1] for i in ids)
    share = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(share, explained, rtol=1e-9)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string, x int")


def test_odd_rows(spark):
    bad = [(90, None, "a", 1), (91, [1.0, None], "a", 1), (92, [float("nan"), 1.0], "a", 1), (93, [float("inf"), 0.0], "a", 1),
           (94, [1.0], "a", 1), (95, [], "a", 1), (96, [1.0, 2.0, None], "a", 1)]
    good = [(1, [0.0, 0.0], "a", 1), (None, [1.0, 0.5], None, 1), (3, [1.0, 0.5], "a", 1), (3, [1.0, 0.5], "a", 1),
            (4, [-2.0, 1.0], "a", 1)]
    out = W.by_component(W.whiten(frame(spark, bad + good))).collect()
    assert sorted(str(r["vec_id"]) for r in out) == sorted(str(i) for i, *_ in good for _ in range(2))
    assert {r["n"] for r in out} == {3} and out[0]["identity_error"] < 1e-12
    copies = {round(r["whitened"], 12) for r in out if r["component"] == 1 and r["vec_id"] in (3, None)}
    assert len(copies) == 1
    for rows in ([], bad, [(1, [1.0, 2.0], "a", 1)] * 3):
        assert W.by_component(W.whiten(frame(spark, rows))).count() == 0
    line = W.by_component(W.whiten(frame(spark, [(i, [float(i), 2.0 * i], "a", 1) for i in range(5)]))).collect()
    assert {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-12
    far = W.whiten(frame(spark, [(1, [1e14, 0.0], "a", 1), (2, [0.0, 1.0], "a", 1)])).collect()
    assert all(r["deviation"] is None for r in far)
