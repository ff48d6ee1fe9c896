"""Nearest neighbours: the curve, recall against brute force, and awkward vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import hilbert_ann as H

from .conftest import TINY

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, k=10, every=100):
    good = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            good.setdefault((i, tuple(np.float32(v).tolist())), np.array(np.float32(v), np.float64))
    out = {}
    for (i, own), q in good.items():
        if i % every:
            continue
        near = sorted((float(np.sqrt(((x - q) ** 2).sum())), j) for (j, _), x in good.items() if j != i)
        out[i] = near[:k]
    return out


def found(df, **params):
    out = {}
    for r in H.search(df, params=H.Params(**params)).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (5, 2)])
def test_the_curve_fills_space_step_by_step(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = H.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_recall(spark):
    df = spark.read.parquet(f"{TINY}/embeddings.parquet").withColumn("vec_id", F.col("vec_id") * 10)
    rows = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    exact, got = brute(rows), found(df)
    assert set(exact) == set(got) and all(len(v) == 10 for v in got.values())
    hits = [len({j for _, j in exact[q]} & {j for _, j in got[q]}) / 10 for q in exact]
    assert np.mean(hits) >= 0.9
    true = {q: dict((j, d) for d, j in v) for q, v in brute(rows, k=1000).items()}
    assert all(abs(d - true[q][j]) < 1e-12 for q, v in got.items() for d, j in v)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(-3, 60)]
    same = [0.5, 0.25, -1.0]
    rows += [(i, same) for i in range(60, 330)]
    rows += [(400, None), (401, []), (402, [0.0, 0.0, 0.0]), (403, [1.0, None, 2.0]), (404, [float("nan"), 1.0, 1.0]), (405, [float("inf"), 1.0, 1.0]), (None, same), (500, rows[5][1]), (500, rows[5][1])]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("q", "d", "c", "r", "keys", "v", "id", "rank", "score"):
        df = df.withColumn(name, F.lit("clash"))
    got, exact = found(df), brute(rows)
    assert set(got) == set(exact) == {0, 100, 200, 300, 500}
    # Equal vectors: the smallest ids, without the query's own.
    for q in (100, 200, 300):
        assert got[q] == exact[q] and [j for _, j in got[q]] == [j for j in range(60, 72) if j != q][:10]
    assert got[0] == exact[0] and got[500] == exact[500]


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.5]), (100, [3.0, 1.0])], SCHEMA)
    assert found(df) == brute([tuple(r) for r in df.collect()])
    assert H.search(df.limit(0)).count() == 0
    assert H.search(spark.createDataFrame([(0, [1.0, 2.0])], SCHEMA)).count() == 0


def test_parts_of_a_window(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = {tuple(r) for r in H.search(df, every=4).collect()}
    assert whole == {tuple(r) for r in H.search(df, every=4, params=H.Params(part=7)).collect()}


def test_the_window_is_fitted_on_vectors_that_differ(spark, monkeypatch):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(300, 8))
    rows = [(i, [float(x) for x in vectors[i if i % 3 else 0]]) for i in range(300)]
    fitted, fit = [], H.fit
    monkeypatch.setattr(H, "fit", lambda sample, *rest: fitted.append(sample) or fit(sample, *rest))
    H.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert len(fitted[0]) == len(np.unique(fitted[0], axis=0)) == 201


def test_recall_well_beyond_the_sample(spark):
    """Five times as many vectors as the window is fitted on, without any structure; queries that have no copy."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(5120, 24)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = found(spark.createDataFrame(rows, SCHEMA), sample=1024)
    exact = brute(rows)
    assert set(got) == set(exact) and all(len(v) == 10 for v in got.values())
    assert np.mean([len({j for _, j in exact[q]} & {j for _, j in got[q]}) / 10 for q in exact]) >= 0.9


def test_structure_narrows_the_windows():
    """Points near a line are found in small windows, points without structure only in large ones."""
    rng = np.random.default_rng(9)
    line = rng.uniform(-50, 50, (2000, 1)) * rng.normal(size=(1, 16)) + rng.normal(size=(2000, 16)) * 0.01
    narrow, wide = (H.fit(x, H.Params(), 10, asked=10**6) for x in (line, rng.normal(size=(2000, 64))))
    assert narrow.window < 0.02 < 0.05 < wide.window
    assert H.Params().least <= len(narrow.shifts) <= H.Params().curves and len(narrow.directions[0]) == len(narrow.shifts) * H.Params().dims


def test_lengths_are_searched_apart(spark):
    rng = np.random.default_rng(10)
    rows = [(i, rng.normal(size=2 + i % 3).astype(np.float32).tolist()) for i in range(600)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    exact = {}
    for n in (2, 3, 4):
        exact |= brute([r for r in rows if len(r[1]) == n])
    assert got == exact
