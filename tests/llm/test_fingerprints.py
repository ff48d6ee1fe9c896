"""Digests against a plain version over the rows in order."""

import hashlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.llm import quartile_digest as D

from .conftest import awkward_rows


def plain(rows):
    """All rows in ascending order of id, null first; each with the next, the last with the first."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    rows = sorted(rows, key=key)
    out = []
    for a, b in zip(rows, rows[1:] + rows[:1]):
        text, following = a[1] or "", b[1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        marks = [D.fingerprint(t.encode()) for t in (text, new, following)]
        out.append(
            (a[0], len(text), hashlib.sha256(new.encode()).hexdigest(), marks[0].tobytes().hex(), marks[1].tobytes().hex(), D.likeness(marks[0], marks[1]), D.likeness(marks[0], marks[2]))
        )
    return sorted(map(repr, out))


def hashed(df):
    body = F.coalesce("text", F.lit(""))
    return [tuple(r) for r in df.select("doc_id", "text", F.xxhash64(body)).collect()]


def test_against_plain_version(spark, awkward, documents, nothing):
    for df in (awkward, documents, documents.limit(1), documents.limit(2)):
        df = spark.createDataFrame(df.collect(), df.schema)
        assert sorted(repr(tuple(r)) for r in D.compare_with_next(df).collect()) == plain(hashed(df))
    assert D.compare_with_next(nothing).count() == 0
    assert len(awkward_rows()) == D.compare_with_next(awkward).count()


def test_many_ranges_and_gaps(spark):
    ids = [-(2**62), -5, 0, 1, 2, 3, 1000, 10**12, 2**62] + list(range(50, 300, 7))
    df = spark.createDataFrame([(i, f"text of {i} " * (abs(i) % 9 + 1)) for i in ids], "doc_id bigint, text string")
    assert sorted(repr(tuple(r)) for r in D.compare_with_next(df).collect()) == plain(hashed(df))


@given(st.binary(max_size=400), st.binary(max_size=400))
def test_likeness_is_bounded_and_symmetric(a, b):
    x, y = D.fingerprint(a), D.fingerprint(b)
    assert D.likeness(x, x) == 1.0 and 0 <= D.likeness(x, y) <= 1 and D.likeness(x, y) == D.likeness(y, x)
    assert len(x) == 2 + D.BUCKETS // 4


def test_digest_codes_are_quartiles():
    raw = bytes(np.random.default_rng(3).integers(97, 123, 5000, dtype=np.uint8))
    counts = [0] * D.BUCKETS
    for i in range(len(raw) - 2):
        value = raw[i] | raw[i + 1] << 8 | raw[i + 2] << 16
        counts[(value * 2654435761 & 0xFFFFFFFF) >> 24] += 1
    ordered = sorted(counts)
    q = [ordered[D.BUCKETS * k // 4 - 1] for k in (1, 2, 3)]
    packed = D.fingerprint(raw)[2:]
    assert [packed[i // 4] >> 2 * (i % 4) & 3 for i in range(D.BUCKETS)] == [sum(c > x for x in q) for c in counts]


def test_edits_are_nearer_than_strangers(documents):
    rows = [r for r in D.compare_with_next(documents).collect() if r.n_chars > 400]
    assert np.mean([r.near_edited for r in rows]) > np.mean([r.near_next for r in rows]) + 0.2


def test_one_key_on_many_rows_is_many_ranges(spark):
    rows = [(7, f"text {i} " * (i % 5 + 1)) for i in range(600)] + [(i, f"other {i}") for i in range(3, 12)] + [(7, "same")] * 40
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(repr(tuple(r)) for r in D.compare_with_next(df).collect()) == plain(hashed(df))
    o = np.array([r[0] for r in rows])
    h = np.array([hash(r[1]) for r in rows])
    places = D._ranges(D._edges(o, h, 25), o, h)
    assert np.bincount(places).max() < 100 and len(set(places.tolist())) > 20
    order = np.lexsort((h, o))
    assert (np.diff(places[order]) >= 0).all()


def plain_digest(raw):
    """(length code, proportions, codes of the buckets), number by number."""
    import math

    counts = [0] * 256
    for i in range(len(raw) - 2):
        counts[((raw[i] | raw[i + 1] << 8 | raw[i + 2] << 16) * 2654435761 & 0xFFFFFFFF) >> 24] += 1
    if len(raw) < 3:
        for x in raw:
            counts[x] = 1
    q1, q2, q3 = (sorted(counts)[k] for k in (63, 127, 191))
    top = max(q3, 1)
    return min(255, int(math.log1p(len(raw)) / math.log(1.1))), (q1 * 15 // top, q2 * 15 // top), [(c > q1) + (c > q2) + (c > q3) for c in counts]


@given(st.binary(max_size=3000), st.binary(max_size=60))
def test_digest_and_likeness_against_a_plain_version(a, b):
    digests = []
    for raw in (a, b):
        length, (r1, r2), codes = plain_digest(raw)
        packed = [codes[i] | codes[i + 1] << 2 | codes[i + 2] << 4 | codes[i + 3] << 6 for i in range(0, 256, 4)]
        assert D.fingerprint(raw).tolist() == [length, r1 << 4 | r2, *packed]
        digests.append((length, r1, r2, codes))
    (l1, p1, q1, c1), (l2, p2, q2, c2) = digests
    apart = sum({0: 0, 1: 1, 2: 2, 3: 6}[abs(x - y)] for x, y in zip(c1, c2)) + abs(l1 - l2) + abs(p1 - p2) + abs(q1 - q2)
    assert abs(D.likeness(D.fingerprint(a), D.fingerprint(b)) - (1 - min(apart, 416) / 416)) < 1e-12
