"""Targets, seats and quantities of the mix against plain versions and the SQL."""

import heapq
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import apportion_mix as M
from palimpsest.llm.queries import OP7_SQL

from .conftest import SCHEMA, SF, awkward_rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_targets(sizes):
    """Shares by weight, stopped and shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s else b""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    capped, left = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        level = left / max(1, sum(weight[s] for s in free))
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return capped | {s: level * weight[s] for s in free}
        for s in over:
            capped[s] = 2.0 * sizes[s]
            left -= capped[s]


def check(rows, got):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    targets = plain_targets(sizes)
    assert sorted(map(str, (g.doc_id for g in got))) == sorted(str(r[0]) for r in rows)
    taken, source = defaultdict(int), {r[0]: r[3] for r in rows}
    for g in got:
        assert 0 <= g.taken <= 2 * g.size
        s = source[g.doc_id]
        assert sizes[s] == g.source_size and abs(targets[s] - g.target) <= 1e-9 * (1 + g.target)
        taken[s] += g.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= max(0.03 * targets[s], M.BLOCK * 2)


def test_awkward(awkward, nothing):
    check(awkward_rows(), M.mix_quantities(awkward).collect())
    assert M.mix_quantities(nothing).count() == M.mixed_documents(nothing).count() == 0


@pytest.mark.parametrize("words", [1, 3, 5])
def test_a_small_source_of_short_texts_in_many_shards(spark, words):
    """A hundred short documents over 32 shards: what a shard has no room for goes to the next."""
    big = spark.range(1000, 16_000).select(F.col("id").alias("doc_id"), F.lit("a b c d e f g h").alias("text"), F.lit("en").alias("lang"), F.lit("z").alias("source"), F.lit(15).cast("bigint").alias("n_chars"))
    small = spark.createDataFrame([(i, " ".join(["w"] * words), "en", "a", 2 * words - 1) for i in range(100)], SCHEMA)
    got = M.mix_quantities(big.unionByName(small)).where("doc_id < 1000").collect()
    assert all(0 <= g.taken <= 2 * g.size for g in got)
    assert got[0].target == 200 * words and 0 <= got[0].target - sum(g.taken for g in got) < 2 * M.BLOCK


def test_empty_texts_alone(spark):
    df = spark.createDataFrame([(1, None, "en", "a", None), (2, "  ", "en", None, 2)], SCHEMA)
    assert sorted(tuple(r) for r in M.mix_quantities(df).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert M.mixed_documents(df).count() == 0


def test_documents_and_sql(documents):
    got = M.mix_quantities(documents)
    check([tuple(r) for r in documents.select("doc_id", "text", "lang", "source").collect()], got.collect())
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(OP7_SQL).fetchall())
    # Again, dealt out otherwise: the same rows.
    again = M.mix_quantities(documents.repartition(7, "text"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("targets,block", [([100.0, 50.0, 25.0, 3.0], 1), ([7.0] * 6, 10), ([1e6, 1.0, 1.0, 2.0], 3), ([5.0], 8), ([10.0, 10.0, 10.0], 7), ([0.0, 40.0], 8)])
def test_seats_against_highest_quotients(spark, targets, block):
    rows = [(str(i), i + 1, t) for i, t in enumerate(targets)]
    df = spark.createDataFrame(rows, "s string, rank int, target double")
    got = {r.s: r.seats for r in M.apportion(df, block).collect()}
    seats = dict.fromkeys(got, 0)
    heap = [(-t, rank, s) for s, rank, t in rows]
    heapq.heapify(heap)
    for _ in range(min(int(sum(targets) // block), 10**7)):
        q, rank, s = heapq.heappop(heap)
        seats[s] += 1
        heapq.heappush(heap, (-targets[rank - 1] / (2 * seats[s] + 1), rank, s))
    assert got == seats


def test_the_mix_itself(documents):
    quantities = {r.doc_id: r for r in M.mix_quantities(documents).collect()}
    mix = M.mixed_documents(documents)
    assert mix.dtypes == documents.dtypes
    texts = {r.doc_id: r.text for r in documents.collect()}
    words = defaultdict(int)
    for r in mix.collect():
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        words[r.doc_id] += len(WORD.findall(r.text))
    assert words == {k: q.taken for k, q in quantities.items() if q.taken}


def test_one_hot_source(spark):
    rows = [(i, "a b c d e", "en", "hot" if i % 3 else f"s{i % 9}", 9) for i in range(600)]
    check(rows, M.mix_quantities(spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit(1))).collect())
