"""The n-gram join against all pairs of small tables, small and large buckets alike."""

import random
from collections import Counter

import numpy as np
import pytest

from palimpsest.llm import ngram_join as J

from .conftest import SCHEMA, awkward_rows


def planted(seed=1, groups=6, copies=30):
    """Groups of near copies, exact copies and strangers that share a long passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(120)]
        for k in range(copies):
            t = list(base)
            for _ in range(k % 5):
                t[rng.randrange(len(t))] = word()
            texts.append(" ".join(t))
    texts += [" ".join([word() for _ in range(40)] + passage + [word() for _ in range(20)]) for _ in range(60)]
    rng.shuffle(texts)
    return [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]


def brute(rows, threshold=0.8):
    def grams(text):
        w = (text or "").split()
        n = min(5, len(w))
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()

    sets = [grams(r[1]) for r in rows]
    root, links = list(range(len(rows))), Counter()

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                p, q = top(i), top(j)
                root[max(p, q)] = min(p, q)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(top(i), []).append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(repr((r[0], least[top(i)], links[i])) for i, r in enumerate(rows))


def found(df, **params):
    return sorted(repr((r.doc_id, r.class_id, r.n_links)) for r in J.near_classes(df, params=J.Params(**params)).collect())


@pytest.mark.parametrize("params", [{}, {"small": 2, "block": 8}, {"small": 1, "block": 1000}, {"small": 10_000}])
def test_planted_groups(spark, params):
    rows = planted()
    assert found(spark.createDataFrame(rows, SCHEMA), **params) == brute(rows)


def test_awkward(awkward, nothing):
    assert found(awkward) == brute(awkward_rows())
    assert J.near_classes(nothing).count() == 0 and J.one_of_each(nothing).count() == 0


def test_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert found(documents) == brute(rows)


def test_one_of_each(spark, awkward):
    rows = planted(seed=2, groups=3, copies=8)
    df = spark.createDataFrame(rows, SCHEMA)
    classes = {eval(x)[1] for x in brute(rows)}
    kept = J.one_of_each(df)
    assert kept.dtypes == df.dtypes and {r.doc_id for r in kept.collect()} == classes
    # Repeated rows: one stays; rows of one id with different texts are different rows.
    got = J.one_of_each(awkward)
    assert got.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(["1", "3", "4", "5", "6", "7", "8", "9", "9", "10", "None", "None"])


def test_one_of_each_decides_by_row(spark):
    rng = random.Random(8)
    x, y, z = (" ".join(f"{c}{rng.randrange(10**6)}" for _ in range(60)) for c in "xyz")
    rows = [(1, x), (5, x), (5, y), (6, z), (6, z + " more"), (7, z), (None, "a lone row without a key"), (None, x), (None, x), (None, x + " more"), (8, ""), (8, "")]
    kept = lambda rows: sorted((str(r.doc_id), r.text) for r in J.one_of_each(spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)).collect())
    got = kept(rows)
    assert got == kept(rows[::-1])
    assert [r for r in got if r[0] in "15"] == [("1", x), ("5", y)]
    assert [i for i, _ in got] == ["1", "5", "6", "8", "None", "None"]
    # No other id repeats: copies without an id are copies all the same.
    assert kept([(1, y), (None, x), (None, x), (None, x)]) == sorted([("1", y), ("None", x)])


def test_recall_sets_the_bands():
    p = J.Params()
    assert 1 - (1 - p.threshold**p.rows) ** p.bands >= p.recall
    assert J.Params(recall=0.9).bands < p.bands


def test_bands_agree_as_often_as_they_should():
    p, rng = J.Params(recall=0.999999), np.random.default_rng(0)
    bander, hits, n = J.Bander(p), 0, 120
    for _ in range(n):
        a = rng.integers(0, 2**63, 200, np.uint64)
        b = np.concatenate([a[:178], rng.integers(0, 2**63, 22, np.uint64)])
        hits += (bander.of(np.sort(a)) == bander.of(np.sort(b))).mean()
    assert abs(hits / n - (178 / 222) ** p.rows) < 0.06


def test_components(spark):
    chain = [(bytes([i]), bytes([i + 1])) for i in range(0, 40)] + [(bytes([100]), bytes([x])) for x in range(101, 140)]
    rows = J.components(spark.createDataFrame(chain, "a binary, b binary")).collect()
    assert {(r.node[0], r.root[0]) for r in rows} == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 140)}
    assert J.components(spark.createDataFrame([], "a binary, b binary")).count() == 0


def test_components_never_ends_unfinished(spark):
    chain = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(60)], "a binary, b binary")
    with pytest.raises(RuntimeError):
        J.components(chain, rounds=1)
    assert {r.root[0] for r in J.components(chain).collect()} == {0}
