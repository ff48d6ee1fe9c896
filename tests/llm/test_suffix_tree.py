"""The language model: its base against brute force, and that its states are distributions."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import suffix_tree_lm as S

from .conftest import SCHEMA, TINY, awkward_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    import re

    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)) + ["\0end"]


def check(rows, got):
    counts = Counter()
    for r in rows:
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10:
            counts.update(words(r[1]))
    n, v = sum(counts.values()), len(counts)
    expected = []
    for r in rows:
        w = words(r[1])
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        held = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0
        expected.append((str(r[0]), held, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6)))
    assert sorted((str(g.doc_id), g.held_out, g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 6)) for g in got) == sorted(expected)


def test_awkward(awkward, nothing):
    for params in (S.Params(), S.Params(counted=3, least=2, follow=1, divergence=0.0)):
        got = S.score(awkward, params=params).collect()
        check(awkward_rows(), got)
        assert all(np.isfinite(g.score) for g in got)
    assert S.score(nothing).count() == 0


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0]
    df = spark.createDataFrame([(i, "a b", "en", "s", 3) for i in ids], SCHEMA)
    rows = S.score(df).collect()
    assert len(rows) == len(ids) and all(r.held_out and r.n_known == 0 and r.train_tokens == 0 for r in rows)


def test_documents_gain(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    for params in (S.Params(), S.Params(counted=500)):
        rows = S.score(docs, params=params).collect()
        check([tuple(r) for r in docs.select("doc_id", "text").collect()], rows)
        held = [r for r in rows if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_states_are_distributions(spark):
    """Each state's probabilities, those of the words not seen there among them, add up to one."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select(F.col("doc_id").alias("k"), F.col("text").alias("t"), F.lit(1).alias("f"))
    texts = S.encoded(docs).select("w")
    counts = S.word_counts(texts).cache()
    n = {r.key: r.n for r in counts.collect()}
    whole = sum(n.values()) + 0.1 * (len(n) + 1)
    assert sum(n.values()) == sum(len(words(r.t)) for r in docs.select("t").collect())
    depth, found = 0, 0
    for states, level in S.levels(texts, counts, whole, S.Params(least=50, follow=3)):
        depth += 1
        back = {r.c: r.back for r in states.collect()}
        seen = {c: [0.0, 0.0] for c in back}
        for r in level.collect():
            seen[r.c][0] += math.exp(r.lp)
            seen[r.c][1] += math.exp(r.below)
            assert r.back == back[r.c] and r.n >= 3
            # What the base leaves for words of no count, 0.1 of them, is left to them here.
            assert depth > 1 or abs(math.exp(r.below) - (n[r.x] + 0.1) / whole) < 1e-12
        assert all(abs(own + math.exp(back[c]) * (1 - below) - 1) < 1e-9 for c, (own, below) in seen.items())
        found += len(back)
    assert found > 20


def test_tables_and_filters(spark):
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(1, 2**63, 5000).astype(np.uint64) * np.uint64(2))
    for some in (keys, keys[:1], keys[:0]):
        table = S.Table(some.view(np.int64), np.arange(len(some), dtype=np.float64))
        at = table.find(keys)
        assert (at[: len(some)] >= 0).all() and (at[len(some) :] < 0).all()
        assert (table.values[at[: len(some)]] == np.arange(len(some))).all() and (table.find(keys + np.uint64(1)) < 0).all()
    held = S.Filter.made(spark.createDataFrame([(int(k),) for k in keys.view(np.int64)[:2000]], "c bigint"))
    assert held.passes(keys[:2000]).all() and held.passes(keys[2000:]).mean() < 0.1
    assert np.array_equal(held.bits, S.Filter.of(keys[:2000]).bits) and not S.Filter.of(keys[:0]).passes(keys).any()


def test_words_of_bytes():
    """Hashes against words cut out by a pattern: white space of every kind, long words, edges of texts."""
    import random
    import re

    rng = random.Random(1)
    texts = ["".join(rng.choice("aAbB \t\n\x0b\x0c\rcé\x1c\x85") for _ in range(rng.randrange(30))) for _ in range(2000)]
    texts += ["x" * 600_000 + " y " + "X" * 600_000 + "z", "", " ", "X" * 600_000 + "z", "X" * 600_000]
    raw = [t.encode() for t in texts]
    keys, counts = S.word_keys(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    expected = [re.findall(rb"[^\x20\x09-\x0d]+", r.lower()) for r in raw]
    assert counts.tolist() == list(map(len, expected))
    of = {}
    assert all(of.setdefault(w, k) == k for w, k in zip((w for x in expected for w in x), keys.tolist(), strict=True))
    assert len(set(of.values())) == len(of) > 1000 and not {S.START, S.END} & set(of.values())


def test_stretches_hold_what_follows_longer_contexts(spark):
    """Against all places of texts after three words of which each pair is frequent."""
    import random

    rng = random.Random(2)
    texts = [[S.START, *(rng.randrange(1, 7) for _ in range(rng.randrange(0, 60))), S.END] for _ in range(300)]
    wanted = {(a, b) for a in range(1, 7) for b in range(1, 7) if (a * b) % 3} | {(S.START, 2), (S.START, 4)}
    hashes = S.longer(np.array([b for _, b in wanted], np.uint64), np.array([a for a, _ in wanted], np.uint64), 2)
    packed = [(np.array(t, np.uint64).tobytes(),) for t in texts]
    rows = S.stretches(spark.createDataFrame(packed * 20, "w binary"), S.Filter.of(hashes)).collect()
    got, expected = [], []
    for r in rows:
        words = np.frombuffer(r.w, np.uint64)
        place = S._places(words, np.array([0, len(words)]))
        got += [tuple(words[i - 3 : i + 1].tolist()) for i in np.flatnonzero(place >= 3)]
        assert words[0] == S.APART and len(words) < 4 * S._ROW
    for t in texts * 20:
        expected += [tuple(t[i - 3 : i + 1]) for i in range(3, len(t)) if (t[i - 3], t[i - 2]) in wanted and (t[i - 2], t[i - 1]) in wanted]
    missed = Counter(expected) - Counter(got)
    assert expected and not missed
    # What a filter lets through in error may be there beside; nothing stands there more often than in the texts.
    every = Counter(tuple(t[i - 3 : i + 1]) for t in texts * 20 for i in range(3, len(t)))
    assert not Counter(got) - every


def test_contexts_stay_within_their_text():
    words, starts = np.array([9, 5, 6, 9, 7], np.uint64), np.array([0, 3, 5])
    place = S._places(words, starts)
    assert place.tolist() == [0, 1, 2, 0, 1]

    class Every:
        def passes(self, keys):
            return np.ones(len(keys), bool)

    at, context, suffix = S._walk(words, place, [Every()], 2)
    one = S.longer(np.zeros(1, np.uint64), words[1:2], 1)
    assert at.tolist() == [2] and suffix.tolist() == one.tolist() and context.tolist() == S.longer(one, words[:1], 2).tolist()


@pytest.mark.parametrize("follow,deviations", [(1, 0.0), (4, 1.0)])
def test_contexts_of_any_number_and_length(spark, follow, deviations):
    """Scores against a plain tree of words, with contexts of three words that tell the next one."""
    import itertools
    import random

    rng = random.Random(4)
    texts = []
    for a, b, c in itertools.product(range(2), range(2), range(2)):
        texts += [" ".join(f"{x}{y}" for x, y in zip("pqr", (a, b, c))) + f" end{a}{b}{c} " + " ".join(f"z{rng.randrange(400)}" for _ in range(5)) for _ in range(40)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    p = S.Params(counted=3, least=8, follow=follow, deviations=deviations, divergence=0.01, prior=5.0)
    train = [["<s>", *words(t)] for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(x for t in train for x in t[1:])
    whole = sum(counts.values()) + 0.1 * (len(counts) + 1)
    states, open_, depth = {}, {()}, 0

    def prob(context, x):
        if not context:
            return (counts[x] + 0.1) / whole
        after = states[context]
        return (after[x] * (after[x] >= follow) + left(after) * prob(context[1:], x)) / (after.total() + p.prior)

    def left(after):
        return p.prior + sum(n for n in after.values() if n < follow)

    while open_:
        depth += 1
        after = {}
        for t in train:
            for i in range(depth, len(t)):
                if t[i - depth + 1 : i] in map(list, open_):
                    after.setdefault(tuple(t[i - depth : i]), Counter())[t[i]] += 1
        open_ = set()
        for c, f in after.items():
            states[c] = f
            seen = [x for x in f if f[x] >= follow]
            q, below = ({x: prob(k, x) for x in seen} for k in (c, c[1:]))
            back = left(f) / (f.total() + p.prior)
            d = sum(q[x] * math.log(q[x] / below[x]) for x in seen) + back * (1 - sum(below.values())) * math.log(back)
            if f.total() >= p.least and seen and d >= p.divergence and 2 * f.total() * d >= len(seen) + deviations * math.sqrt(2 * len(seen)):
                open_.add(c)
            else:
                del states[c]
    # More than one state of two words, and states of three.
    assert sum(len(c) == 2 for c in states) > 1 and max(map(len, states)) >= 3
    for held in (0, 10, 10**6):  # what the tasks hold of terms, and of contexts tested before
        got = {r.doc_id: r.score for r in S.score(spark.createDataFrame(rows, SCHEMA), params=S.Params(**(vars(p) | {"terms": held}))).collect()}
        for i, t in enumerate(texts):
            seq, expected = ["<s>", *words(t)], 0.0
            for k in range(1, len(seq)):
                c = max((tuple(seq[j:k]) for j in range(k + 1) if j == k or tuple(seq[j:k]) in states), key=len)
                expected += math.log10(prob(c, seq[k]))
            assert abs(got[i] - expected) < 1e-6


def test_runs_count_the_same(spark, monkeypatch):
    """Against the plain tree, where each run counts its share of what follows contexts."""
    monkeypatch.setattr(S, "_ONE_RUN", 0)
    monkeypatch.setattr(S, "RUNS", 3)
    rows, cut = [], S.cut

    def counted(df, name):
        out = cut(df, name)
        if name == "lm-counts":
            rows.append(out.count())
        return out

    monkeypatch.setattr(S, "cut", counted)
    test_contexts_of_any_number_and_length(spark, 4, 1.0)
    assert len(rows) >= 9 and max(rows[:3]) < sum(rows[:3])


def test_files_go_when_nothing_reads_them(spark):
    import glob

    from palimpsest.llm.common import scratch

    def tables():
        return {f.rsplit("/", 1)[1] for f in glob.glob(scratch(spark).removeprefix("file://") + "/lm-*")}

    before = tables()
    rows = S.score(spark.read.parquet(f"{TINY}/documents.parquet"))
    # What the result reads; not the texts, nor what their contexts were counted by.
    assert sorted(t.split("-")[1] for t in tables() - before) == ["scored", "terms", "words"]
    assert rows.count() == spark.read.parquet(f"{TINY}/documents.parquet").count()


def test_shuffles_go_with_the_table_they_made(spark):
    import glob
    import time

    from palimpsest.sources import storage

    def shuffles():
        dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}

    setting = spark.conf.get(S._CLEAN)
    rows, held = spark.range(100_000).repartition(4), shuffles()
    storage.cut(rows, "lm-any")
    kept = shuffles() - held
    S.cut(rows, "lm-any")
    until = time.time() + 20
    while (left := shuffles() - held - kept) and time.time() < until:
        time.sleep(0.2)
    assert kept and not left and spark.conf.get(S._CLEAN) == setting


def test_seldom_pairs_are_not_shuffled(spark, monkeypatch):
    """Of the pairs of a text of many words, those that stand there seldom meet in a shuffle as short hashes only."""
    monkeypatch.setattr(S, "_ONE_RUN", 0)
    monkeypatch.setattr(S, "_PART", 5000)
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["the", "same", "old", "words"] * 3 + [f"w{x}" for x in rng.integers(0, 40, 60)]), 1) for i in range(300)]
    texts = S.encoded(spark.createDataFrame(rows, "k int, t string, f int")).select("w")
    pairs = lambda words, place: [(words[np.flatnonzero(place > 0) - 1], words[place > 0])]
    exact = {(r.a, r.b): r.n for r in S._counted(texts, pairs).collect()}
    for least in (5, 15):
        passed = S.frequent(texts, pairs, least, 300 * 74)
        key = lambda k: S.followed(*(np.array([x], np.int64).view(np.uint64) for x in k))
        fits = {k for k in exact if passed.passes(key(k))[0]}
        often = {k for k, n in exact.items() if n >= least}
        assert often <= fits and len(fits) <= len(often) + len(exact) // 10
    sizes, counted = [], S._counted

    def watched(where, found):
        """The level's pairs that go into the shuffle."""
        sizes.append(sum(r.n for r in counted(where, found).select("n").collect()))
        return counted(where, found)

    words = S.word_counts(texts)
    monkeypatch.setattr(S, "_counted", watched)
    list(S.levels(texts, words, 22200.0, S.Params(least=50, follow=15)))
    assert sizes[0] <= 1.1 * sum(n for n in exact.values() if n >= 15) < sum(exact.values()) * 0.9


def test_texts_are_packed_in_blocks(spark):
    """A hash stands once in a block; words, texts and their rows come back as they were, those that are not learnt from apart."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.5, i % 90) % 1000) if i % 7 else None, i % 3) for i in range(600)]
    blocks = S.encoded(spark.createDataFrame(rows, "k int, t string, f int").repartition(2)).toArrow().combine_chunks()
    assert 1 < blocks.num_rows < 60
    got, size = {}, 0
    for batch in blocks.to_batches():
        size += sum(map(len, batch["w"].to_pylist()))
        for part, w, starts in S._sequences([batch.select(["k", "f", "w"])]):
            for k, f, a, b in zip(part["k"].to_pylist(), part["f"].to_pylist(), starts, starts[1:]):
                got[k] = (f, w[a:b].tolist())
    raw = {k: (t or "").encode() for k, t, _ in rows}
    keys = {k: S.word_keys(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0].tolist() for k, t in raw.items()}
    assert got == {k: (f, [S.START, *keys[k], S.END]) for k, _, f in rows}
    assert all((f > 0) == train for fs, train in zip(blocks["f"].to_pylist(), blocks["train"].to_pylist()) for f in fs)
    assert size < 4 * sum(len(w) for _, w in got.values())
    for words in (np.array([S.START], np.uint64), np.array([S.APART, 3, 3, 4, S.APART, 9], np.uint64), np.arange(70_000, dtype=np.uint64)):
        assert np.array_equal(S.unpack_words(S.pa.py_buffer(S.pack_words(words))), words)
