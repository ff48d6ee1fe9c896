"""Toxicity and quality: held-out accuracy, folds, awkward rows, and the parts of the methods."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import ftrl_toxicity as T
from palimpsest.llm import rff_quality as Q

from .conftest import TINY, awkward_rows


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{TINY}/documents.parquet"), spark.read.parquet(f"{TINY}/labels.parquet")


@pytest.mark.parametrize("op,label,folds,out,floor", [(T, "toxic", 5, 0, 0.88), (Q, "quality", 4, 2, 0.95)])
def test_held_out(labelled, op, label, folds, out, floor):
    docs, labels = labelled
    scored = op.score(docs, op.fit(docs, labels)).withColumn("held", op.held_out())
    rows = scored.join(labels, "doc_id").collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % folds == out) for r in rows)
    held = [r for r in rows if r.held]
    assert np.mean([r.predicted == r[label] for r in held]) >= floor
    ones, zeros = [[r.score for r in held if r[label] == y] for y in (1, 0)]
    assert np.mean([a > b for a in ones for b in zeros]) >= 0.9
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("op", [T, Q])
def test_labels_of_the_held_out_are_not_learnt(labelled, op):
    docs, labels = labelled
    name = "toxic" if op is T else "quality"
    flipped = labels.withColumn(name, F.when(op.held_out(), 1 - F.col(name)).otherwise(F.col(name)))
    a, b = op.fit(docs, labels), op.fit(docs, flipped)
    for x, y in zip(vars(a).values(), vars(b).values()):
        assert np.array_equal(x, y)


@pytest.mark.parametrize("op", [T, Q])
def test_awkward(spark, labelled, awkward, nothing, op):
    docs, labels = labelled
    bad = labels.unionByName(spark.createDataFrame([(None, 1, 1), (5, None, None), (5, 7, -1)], labels.schema))
    model = op.fit(docs, bad)
    rows = op.score(awkward, model).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(r[0]) for r in awkward_rows())
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert op.score(nothing, model).count() == 0
    kept = op.score(awkward, model, keep=True)
    assert set(kept.columns) == set(awkward.columns) and dict(kept.dtypes)["score"] == "double"
    # Nothing to learn from: a score all the same.
    assert op.score(docs.limit(3), op.fit(nothing, labels)).count() == 3
    assert op.score(docs.limit(3), op.fit(docs, labels.limit(0))).count() == 3


def test_ftrl_is_sparse_and_finds_the_word():
    f = T.Features(12)
    examples = [(f.of(f"w{i % 50} w{i % 7}" + " vile" * (i % 3 == 0)), float(i % 3 == 0)) for i in range(600)]
    model = T.train(examples, T.Params(bits=12, l1=4.0, alpha=0.5))
    vile = int(f.of("vile")[0])
    assert len(model.at) < 40 and model.dense()[vile] == model.weight.max() > 0


def test_features_are_words_pairs_and_skips():
    f = T.Features(30)
    one = set(f.of("a b c").tolist())
    assert len(one) == 6 and set(f.of("a").tolist()) < one and set(f.of("B, c").tolist()) < one
    assert len(f.of("")) == len(f.of(None)) == 0


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(0)
    w, y = rng.integers(1, 5, 7).astype(float), rng.random(7)
    got = Q.isotonic(w, y)
    # The value at i is the greatest, over starts up to i, of the least mean to an end from i.
    mean = lambda a, b: (w[a : b + 1] * y[a : b + 1]).sum() / w[a : b + 1].sum()
    expected = [max(min(mean(a, b) for b in range(i, 7)) for a in range(i + 1)) for i in range(7)]
    assert np.allclose(got, expected)


def test_features_approximate_the_kernel():
    p = Q.Params(features=4096)
    rng = np.random.default_rng(1)
    d = len(Q.STATISTICS)
    model = Q.Model(np.zeros(d), np.ones(d), rng.normal(size=(d, 4096)) / p.width, rng.uniform(0, 2 * np.pi, 4096), np.zeros(4097), np.zeros(1), np.zeros(1))
    x = rng.normal(size=(6, d))
    z = model.features(x)
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * p.width**2))
    assert np.abs(z @ z.T - kernel).max() < 0.08


def test_statistics_of_odd_texts():
    for text in (None, "", " ", "\n\n", "!!!", "ä", "a b a b", "x" * 10_000):
        s = Q.statistics(text)
        assert len(s) == len(Q.STATISTICS) and np.isfinite(s).all()


def test_ftrl_against_a_plain_version():
    """Coordinate by coordinate, in dictionaries, as the method is written down."""
    rng = np.random.default_rng(5)
    examples = [(np.unique(rng.integers(0, 64, rng.integers(0, 9))).astype(np.int32), float(rng.random() < 0.4)) for _ in range(200)]
    p = T.Params(bits=6, epochs=3, l1=0.7, l2=0.3, alpha=0.4, beta=0.9)
    z, n = dict.fromkeys(range(65), 0.0), dict.fromkeys(range(65), 0.0)

    def weight(i):
        l1, l2 = (0.0, 0.0) if i == 64 else (p.l1, p.l2)
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((p.beta + n[i] ** 0.5) / p.alpha + l2)

    for _ in range(p.epochs):
        for at, y in examples:
            w = {i: weight(i) for i in (*at.tolist(), 64)}
            g = 1 / (1 + np.exp(-sum(w.values()))) - y
            for i, wi in w.items():
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / p.alpha * wi
                n[i] += g * g
    model = T.train(examples, p)
    assert np.allclose(model.dense(), [weight(i) for i in range(64)], atol=1e-6) and abs(model.bias - weight(64)) < 1e-9
    assert 0 < (model.dense() == 0).sum() < 64


def test_fit_learns_from_the_sample_in_its_order(labelled):
    docs, labels = labelled
    p = T.Params(sample=150, epochs=2)
    sample = T.labelled_sample(docs, labels, "toxic", 5, 0, p.sample).collect()
    assert len(sample) == 150
    f = T.Features(p.bits)
    plain = T.train([(f.of(r.text), r.y) for r in sorted(sample, key=lambda r: (r.h, f.of(r.text).tobytes()))], p)
    got = T.fit(docs, labels, p)
    assert np.array_equal(got.at, plain.at) and np.allclose(got.weight, plain.weight, atol=1e-6) and abs(got.bias - plain.bias) < 1e-9


def test_ridge_against_a_direct_solution(labelled):
    """The normal equations, on the driver, of the rows that are not set aside for calibration; the
    calibration against the isotonic values of those that are."""
    docs, labels = labelled
    p = Q.Params(features=32, sample=200, bins=64)
    got = Q.fit(docs, labels, p)
    sample = Q.labelled_sample(docs, labels, "quality", 4, 2, p.sample).withColumn("aside", F.pmod(F.xxhash64("h"), F.lit(p.calibrate)) == 0).collect()
    x, y, aside = np.array([Q.statistics(r.text) for r in sample]), np.array([r.y for r in sample]), np.array([r.aside for r in sample])
    assert 20 < aside.sum() < 90
    fitted, n = x[~aside], (~aside).sum()
    assert np.allclose(got.mean, fitted.mean(0), atol=1e-6) and np.allclose(got.scale, fitted.std(0), atol=1e-4)
    z = np.hstack([got.features(fitted), np.ones((n, 1))])
    left = z.T @ z + np.diag([p.ridge * n / 32] * 32 + [0.0])
    assert np.allclose(np.linalg.solve(left, z.T @ y[~aside]), got.coefficients, atol=1e-4)
    at = np.clip(((got.margin(x[aside]) + 0.5) / 2 * p.bins).astype(int), 0, p.bins - 1)
    used = np.unique(at)
    assert np.allclose(got.edges, (used + 0.5) / p.bins * 2 - 0.5)
    assert np.allclose(got.values, Q.isotonic(np.bincount(at)[used].astype(float), np.array([y[aside][at == b].mean() for b in used])))


@pytest.mark.parametrize("op", [T, Q])
def test_reruns_agree_where_an_id_stands_on_many_rows(spark, labelled, op):
    docs, labels = labelled
    many = docs.unionByName(docs.withColumn("text", F.concat(F.lit("other words "), F.reverse("text")))).unionByName(docs)
    a, b = op.fit(many.repartition(7), labels), op.fit(many.repartition(3, "text"), labels)
    for x, y in zip(vars(a).values(), vars(b).values()):
        assert np.array_equal(x, y)
