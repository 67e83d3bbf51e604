"""Similarity join by metric partitioning and search in place, against numpy."""
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from threadlake.operators import vectors as V
from threadlake.sources import driver_tables as D


def _table(spark, x):
    rows = [(f"s{i % 97}", i // 97, [float(c) for c in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "session_id string, turn_idx int, embedding array<float>")


def _unit(x):
    x = np.asarray(x, np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _clustered(rng, n, clusters=30, dims=16, spread=0.05):
    centres = _unit(rng.standard_normal((clusters, dims)))
    return _unit(centres[rng.integers(0, clusters, n)] + spread * rng.standard_normal((n, dims)))


def _brute(x, k, threshold):
    """{key: [(key, cos)]} of the k nearest others above the threshold, ties by key."""
    x = np.asarray(x, np.float32).astype(np.float64)
    keys = [(f"s{i % 97}", i // 97) for i in range(len(x))]
    out = {}
    for i, v in enumerate(x):
        cos = 1 - ((x - v) ** 2).sum(1) / 2
        best = sorted((-round(float(c), 9), keys[j], float(c)) for j, c in enumerate(cos) if j != i and c >= threshold)[:k]
        out[keys[i]] = [(key, c) for _, key, c in best]
    return out


def _got(df):
    out = {}
    for r in df.collect():
        out.setdefault((r["src_session_id"], r["src_turn_idx"]), []).append(
            ((r["dst_session_id"], r["dst_turn_idx"]), r["cos"]))
    return {k: sorted(v, key=lambda x: (-round(x[1], 9), x[0])) for k, v in out.items()}


def _same(got, want):
    assert got.keys() == {k for k, v in want.items() if v}
    for k, v in got.items():
        assert [a for a, _ in v] == [a for a, _ in want[k]] and np.allclose([c for _, c in v], [c for _, c in want[k]], atol=1e-9)


CASES = {
    "clusters": lambda rng: _clustered(rng, 1500),
    "copies": lambda rng: np.vstack([np.repeat(_clustered(rng, 1), 500, 0), _clustered(rng, 600), np.repeat(_clustered(rng, 3), 4, 0)]),
    "one cell": lambda rng: _clustered(rng, 700, clusters=1, spread=0.01),
    "no clusters": lambda rng: _unit(rng.standard_normal((400, 8))),
    "few": lambda rng: _clustered(rng, 3),
}


@pytest.mark.parametrize("name", CASES)
def test_similar_pairs(spark, name):
    x = CASES[name](np.random.default_rng(4))
    for k, threshold in ((5, 0.85), (2, 0.4)):
        _same(_got(V.similar_pairs(_table(spark, x), k, threshold, chunk=128)), _brute(x, k, threshold))


def test_few_comparisons_on_clusters(spark):
    x = _clustered(np.random.default_rng(1), 4000)
    radius = math.sqrt(2 * (1 - 0.85))
    _, vectors = V.distinct_vectors(_table(spark, x), 5)
    cells = V.cells_of(vectors.persist(), 4000, radius)
    assert cells.comparisons < 0.2 * 4000 ** 2
    assert sum(m for m, _, _ in cells.stats.values()) == 4000


def test_a_wide_radius_leaves_a_task_in_small_batches(spark, monkeypatch):
    """Every vector reaches every cell: the copies go out a few at a time, and
    counting them moves no vector."""
    monkeypatch.setattr(V, "SEND", 16 * 50)
    x = _unit(np.random.default_rng(2).standard_normal((400, 16))).astype(np.float64)
    ids = pa.array([{"a": i, "b": i} for i in range(400)], pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([ids, pa.array(x.tolist()), pa.array([0] * 400, pa.int32())], ["vid", "vec", "cell"])
    d = V._distances(x, x[:20])
    parts = list(V._sent(batch, d, np.ones(d.shape, bool)))
    assert max(p.num_rows for p in parts) == 50 and sum(p.num_rows for p in parts) == 400 * 20
    _, vectors = V.distinct_vectors(_table(spark, x), 5)
    cells = V.cells_of(vectors.persist(), 400, 2.0)
    assert cells.comparisons == 400 ** 2 and cells.reach.count() == 400 * len(cells.stats)


def test_lsh_with_wide_buckets_is_joined_in_blocks(spark):
    """Two buckets a table hold half of the vectors each: the pairs of one bucket
    are compared by blocks, and the rows are those of a join by bucket."""
    rng = np.random.default_rng(6)
    x = np.vstack([_clustered(rng, 500, dims=32), np.repeat(_clustered(rng, 2, dims=32), 20, 0)])
    wide = V.wire_similar_lsh(_table(spark, x), k=3, threshold=0.4)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    share, V.SELECTIVE = V.SELECTIVE, 2.0 * 6
    try:
        by_bucket = V.wire_similar_lsh(_table(spark, x), k=3, threshold=0.4)
        assert "FlatMapCoGroupsInArrow" not in by_bucket._jdf.queryExecution().executedPlan().toString()
    finally:
        V.SELECTIVE = share
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, by_bucket.collect())) and wide.count() > 500


def test_lsh_with_repeated_keys(spark):
    """A row given twice counts once; two vectors of one turn share its places."""
    x = _clustered(np.random.default_rng(8), 60, clusters=2, dims=8)
    rows = [(f"s{i}", 0, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += rows[:5] + [("s7", 0, [float(c) for c in x[9]])]
    got = V.wire_similar_lsh(spark.createDataFrame(rows, "session_id string, turn_idx int, embedding array<float>"), k=3,
                             threshold=0.4).collect()
    assert sum(r["src_session_id"] == "s0" for r in got) == 3
    assert sum(r["src_session_id"] == "s7" for r in got) <= 3  # its own rows take places


@pytest.mark.parametrize("block", [4096, 4, 1])
def test_knn(spark, block):
    rng = np.random.default_rng(9)
    x = np.vstack([_clustered(rng, 600), np.repeat(_clustered(rng, 2), 40, 0)])
    q = np.vstack([x[:3], _unit(rng.standard_normal((10, 16))), x[-1:]]).astype(np.float64)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id long, qvec array<double>")
    x64 = np.asarray(x, np.float32).astype(np.float64)
    for k in (1, 7, 2000):
        got = {}
        for r in V.knn(queries, _table(spark, x), k, chunk=64, block=block).collect():
            got.setdefault(r["query_id"], []).append((r["knn_rank"], r["session_id"], r["turn_idx"], r["cos"]))
        for i, v in enumerate(q):
            cos = 1 - ((x64 - v) ** 2).sum(1) / 2
            want = sorted((-round(float(c), 9), f"s{j % 97}", j // 97) for j, c in enumerate(cos))[:k]
            assert [r[1:3] for r in sorted(got[i])] == [w[1:] for w in want]
    assert V.knn(queries.limit(0), _table(spark, x), 3).count() == 0
    assert V.knn(queries, _table(spark, x).limit(0), 3).count() == 0


def test_knn_does_not_shuffle_vectors(spark, tmp_path):
    e = D.table(spark, SF_SMALL, "embeddings")
    e.select(F.col("vec_id").cast("string").alias("session_id"), F.lit(0).alias("turn_idx"), "embedding").write.parquet(str(tmp_path / "v"))
    q = V.centroids(e, "label", "embedding").select(F.col("label").cast("long").alias("query_id"), "qvec")
    plan = V.knn(q, spark.read.parquet(str(tmp_path / "v")), 5)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "Exchange" not in below and plan.count("Exchange hashpartitioning(query_id") == 1


def test_only_new_and_changed_texts_reach_the_encoder(spark):
    turns = spark.createDataFrame([(f"s{i}", 0, "user", f"a text that is long enough to embed {i}") for i in range(300)],
                                  "session_id string, turn_idx int, role string, text string")
    calls, largest = spark.sparkContext.accumulator(0), 32

    def make_model():
        plain = V.hashing_model(16)

        def model(texts):
            assert len(texts) <= largest
            calls.add(len(texts))
            return plain(texts)
        return model

    first = V.embed_turns(turns, None, make_model, 16, largest).persist()
    assert first.count() == 300 and calls.value == 300
    later = turns.withColumn("text", F.when(F.col("session_id").isin("s1", "s2"), F.lower(F.concat(F.lit("new "), "text")))
                             .otherwise(F.col("text"))).filter("session_id != 's3'")
    now = V.refresh_vectors(later, first, make_model, 16, largest).persist()
    assert now.count() == 299 and calls.value == 302
    assert now.select("session_id", "turn_idx").distinct().count() == 299
    same = now.join(first, ["session_id", "turn_idx", "text_hash", "embedding"]).count()
    assert same == 297
