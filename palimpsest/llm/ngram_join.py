"""N-gram Jaccard join by MinHash banding.

A document is its set of hashed word n-grams.  Documents with equal sets form one
class, so copies are never paired.  Class representatives are banded by MinHash;
the numbers of bands and rows follow from a target recall at the threshold.
Small buckets give pairs, checked on the full sets.  Large buckets are split
into blocks, and each pair of blocks is checked within one task, which gives back
counts and spanning links, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Memo, cut, of_texts, slices

#: Parts that a group's members are dealt into where each is given its least key.
SALTS = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Params:
    """``rows`` of a band, and bands for ``recall`` of the pairs at the threshold.
    A bucket of up to ``small`` members gives pairs; a larger one is cut into blocks
    of ``block`` members."""

    n: int = 5
    threshold: float = 0.8
    recall: float = 0.9999
    rows: int = 5
    small: int = 12
    block: int = 2048
    seed: int = 3

    @property
    def bands(self) -> int:
        return int(np.ceil(np.log(1 - self.recall) / np.log(1 - self.threshold**self.rows)))


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of whole texts.

    Words are split at white space.  A text of fewer than n words is one n-gram of
    all its words; a null, empty or blank text has none."""

    def __init__(self, n: int = 5, memo: int = 300_000) -> None:
        self.n = n
        self.words = Memo(xxhash.xxh3_64_intdigest, memo)

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        w = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(w))
        if n == 0:
            return w
        h = np.zeros(len(w) - n + 1, np.uint64)
        for i in range(n):
            h = (h ^ w[i : len(w) - n + 1 + i]) * _MIX
            h ^= h >> np.uint64(29)
        return np.unique(h * np.uint64(2 * n + 1))


class Bander:
    """Band hashes of n-gram sets."""

    def __init__(self, params: Params) -> None:
        rng = np.random.default_rng(params.seed)
        k = params.bands * params.rows
        self.params = params
        self.a = rng.integers(1, 2**63, k, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, k, np.uint64)
        self.c = rng.integers(1, 2**63, params.rows, np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, grams: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(grams), 2048):
            x = grams[i : i + 2048, None] * self.a + self.b
            np.minimum(least, (x ^ (x >> np.uint64(32))).min(axis=0), out=least)
        rows = least.reshape(self.params.bands, self.params.rows) * self.c
        rows ^= rows >> np.uint64(31)
        return (rows.sum(axis=1, dtype=np.uint64) * _MIX).view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return both / union if union else 0.0


def links_within(sets_a: list, bands_a: np.ndarray, sets_b: list | None, bands_b: np.ndarray, band: int, threshold: float) -> np.ndarray:
    """Index pairs of similar members of one bucket (``sets_b`` None: within a block),
    without those that an earlier band brings together already."""
    same = sets_b is None
    if same:
        sets_b = sets_a
    n, m = len(sets_a), len(sets_b)
    open_pairs = np.triu(np.ones((n, m), bool), 1) if same else np.ones((n, m), bool)
    for k in range(band):
        open_pairs &= bands_a[:, k][:, None] != bands_b[:, k][None, :]
    size_a, size_b = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    open_pairs &= np.minimum(size_a[:, None], size_b[None, :]) >= threshold * np.maximum(size_a[:, None], size_b[None, :])
    if not open_pairs.any():
        return np.empty((0, 2), np.int64)
    grams = np.concatenate(sets_b)
    owner = np.repeat(np.arange(m), size_b)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    found = []
    for i in np.flatnonzero(open_pairs.any(axis=1)):
        start, stop = np.searchsorted(grams, sets_a[i], "left"), np.searchsorted(grams, sets_a[i], "right")
        lengths = stop - start
        at = np.repeat(start - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        both = np.bincount(owner[at], minlength=m)
        ok = open_pairs[i] & (both >= threshold * (size_a[i] + size_b - both) - 1e-9)
        found += [(i, j) for j in np.flatnonzero(ok)]
    return np.array(found, np.int64).reshape(-1, 2)


@dataclass
class Joined:
    """rows: (id, mark, h) of every row, mark null without n-grams, h a hash of the text.  classes: (mark, id,
    copies, n) of every n-gram set, id its least key.  links: (a, b) marks of similar
    sets: every pair of small buckets, and enough to span the groups of large ones.
    counts: (mark, links), similar rows in other classes, copies included."""

    rows: DataFrame
    classes: DataFrame
    links: DataFrame
    counts: DataFrame


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> Joined:
    """Similar classes of ``docs``.  Null and empty texts link to nothing.  Repeated
    rows and ids are copies like any others; rows of one key with different texts
    stay apart.  Other columns are left aside; an empty table gives empty tables."""
    kind = docs.schema[key].dataType.simpleString()
    kept = of_texts(docs).select(F.col(key).alias("id"), F.col(text).cast("string").alias("t")).withColumn("h", F.xxhash64("t"))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bander = Shingler(params.n), Bander(params)
        for batch in slices(batches):
            grams = [shingler.of(t) for t in batch["t"].to_pylist()]
            marks = [_mark(g) for g in grams]
            bands = [bander.of(g).tobytes() if len(g) else None for g in grams]
            columns = [batch["id"], pa.array(marks, pa.binary()), pa.array(bands, pa.binary()), pa.array([len(g) for g in grams], pa.int32()), batch["h"]]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "mark", "bands", "n", "h"])

    rows = cut(kept.mapInArrow(signed, f"id {kind}, mark binary, bands binary, n int, h bigint"), "join-rows")
    classes = cut(rows.where("mark is not null").groupBy("mark", "bands", "n").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "join-classes")

    banded = _bands(classes, params)
    sizes = banded.groupBy("band", "hash").agg(F.count("*").alias("m"), F.sum("n").alias("grams")).where("m > 1")
    buckets = cut(banded.join(sizes, ["band", "hash"]).select("band", "hash", "mark", "m", sizes["grams"]), "join-buckets")
    sets = _sets(kept, cut(classes.join(buckets.select("mark").distinct(), "mark", "left_semi"), "join-wanted"), params)

    small = buckets.where(F.col("m") <= params.small)
    pairs = small.select("band", "hash", F.col("mark").alias("a")).join(small.select("band", "hash", F.col("mark").alias("b")), ["band", "hash"])
    close = _verified(pairs.where("a < b").groupBy("a", "b").agg(F.min("band").alias("band")), sets, params)
    far = cut(_in_blocks(buckets.where(F.col("m") > params.small), sets, params), "join-blocks")
    close = cut(close, "join-links")

    links = close.select("a", "b").union(far.where("b is not null").select("a", "b"))
    counts = (
        close.select(F.col("a").alias("mark"), F.col("copies_b").alias("links"))
        .union(close.select("b", "copies_a"))
        .union(far.where("b is null").select("a", "links"))
        .groupBy("mark")
        .agg(F.sum("links").alias("links"))
    )
    return Joined(rows.select("id", "mark", "h"), classes.select("mark", "id", "copies", "n"), links, counts)


def _mark(grams: np.ndarray) -> bytes | None:
    return blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def _bands(classes: DataFrame, params: Params) -> DataFrame:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = batch.num_rows
            hashes = np.frombuffer(b"".join(batch["bands"].to_pylist()), np.int64)
            at = pa.array(np.repeat(np.arange(n), params.bands))
            band = pa.array(np.tile(np.arange(params.bands, dtype=np.int16), n))
            yield pa.RecordBatch.from_arrays([batch["mark"].take(at), batch["n"].take(at), band, pa.array(hashes)], names=["mark", "n", "band", "hash"])

    return classes.select("mark", "bands", "n").mapInArrow(split, "mark binary, n int, band smallint, hash bigint")


#: Least and most bits of the filter that keeps texts without a candidate out of the shuffle:
#: sixteen a candidate between these.  What it lets through in error goes at the exact join after it.
_LEAST_BITS, _MOST_BITS = 16, 28


def _sets(docs: DataFrame, wanted: DataFrame, params: Params) -> DataFrame:
    """(mark, copies, bands, grams) of the classes ``wanted``, from the text of their least key."""
    size = 1 << max(_LEAST_BITS, min(_MOST_BITS, (16 * wanted.count()).bit_length()))
    slot = F.pmod(F.xxhash64("id"), F.lit(size))
    words = wanted.select(slot.alias("s")).groupBy(F.shiftright("s", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[words["w"].to_numpy()] = words["bits"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(params.n)
        for batch in slices(batches):
            s = batch["s"].to_numpy()
            keep = pa.array((shared.value[s >> 6] >> (s & 63).astype(np.uint64) & np.uint64(1)).astype(bool))
            grams = [shingler.of(t) for t in batch["t"].filter(keep).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([_mark(g) for g in grams], pa.binary()), pa.array([g.tobytes() for g in grams], pa.binary()), batch["id"].filter(keep)], names=["mark", "grams", "id"])

    kind = docs.schema["id"].dataType.simpleString()
    found = docs.select("id", "t", slot.alias("s")).mapInArrow(made, f"mark binary, grams binary, id {kind}")
    own = wanted.select("mark", F.col("id").alias("least"), "copies", "bands")
    joined = found.join(own, "mark").where(F.col("id").eqNullSafe(F.col("least")))
    # A key with one text on several rows gives its set several times.
    turn = Window.partitionBy("mark").orderBy("id")
    return cut(joined.withColumn("turn", F.row_number().over(turn)).where("turn = 1").select("mark", "copies", "bands", "grams"), "join-sets")


def _verified(pairs: DataFrame, sets: DataFrame, params: Params) -> DataFrame:
    """(a, b, copies_a, copies_b): the pairs whose full sets are similar, of those that no
    band before ``band`` brings together: that would be in a large bucket, and counts there."""
    columns = ("copies", "bands", "grams")
    a = sets.select(F.col("mark").alias("a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    b = sets.select(F.col("mark").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])

    def first(x: bytes, y: bytes) -> int:
        return int((np.frombuffer(x, np.int64) == np.frombuffer(y, np.int64)).argmax())

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = [
                jaccard(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= params.threshold - 1e-12
                if min(len(x), len(y)) >= params.threshold * max(len(x), len(y)) and first(p, q) == band
                else False
                for x, y, p, q, band in zip(*(batch[c].to_pylist() for c in ("grams_a", "grams_b", "bands_a", "bands_b", "band")))
            ]
            yield batch.select(["a", "b", "copies_a", "copies_b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(a, "a").join(b, "b").select("a", "b", "band", *[f"{c}_{x}" for x in "ab" for c in columns])
    return both.mapInArrow(checked, "a binary, b binary, copies_a bigint, copies_b bigint")


def _in_blocks(buckets: DataFrame, sets: DataFrame, params: Params) -> DataFrame:
    """(a, b, links): with b, links that span the similar members of a bucket; without
    b, the number of rows similar to a.  Members of a bucket are dealt into blocks by
    their marks, blocks being few enough in members and n-grams for one task."""
    blocks = F.greatest(F.ceil(F.col("m") / params.block), F.ceil(F.col("grams_all") / 2_000_000)).cast("int")
    own = F.pmod(F.xxhash64("mark", "band"), F.col("blocks").cast("bigint")).cast("int")
    members = (
        buckets.withColumnRenamed("grams", "grams_all")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .join(sets, "mark")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("band", "hash", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "mark", "copies", "bands", "grams")
    )

    def linked(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        i, j, band = table["i"][0].as_py(), table["j"][0].as_py(), table["band"][0].as_py()
        marks, copies = table["mark"].to_pylist(), table["copies"].to_numpy()
        grams = [np.frombuffer(g, np.uint64) for g in table["grams"].to_pylist()]
        bands = np.frombuffer(b"".join(table["bands"].to_pylist()), np.int64).reshape(len(marks), -1)
        own = table["own"].to_numpy()
        first, second = np.flatnonzero(own == i), np.flatnonzero(own == j)
        if i == j:
            found = links_within([grams[k] for k in first], bands[first], None, bands[first], band, params.threshold)
            found = first[found]
        else:
            found = np.empty((0, 2), np.int64)
            if len(first) and len(second):
                found = links_within([grams[k] for k in first], bands[first], [grams[k] for k in second], bands[second], band, params.threshold)
                found = np.column_stack([first[found[:, 0]], second[found[:, 1]]])
        links = np.zeros(len(marks), np.int64)
        np.add.at(links, found[:, 0], copies[found[:, 1]])
        np.add.at(links, found[:, 1], copies[found[:, 0]])
        root = list(range(len(marks)))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        span = []
        for x, y in found.tolist():
            p, q = top(x), top(y)
            if p != q:
                root[q] = p
                span.append((marks[x], marks[y]))
        some = np.flatnonzero(links)
        a = [x for x, _ in span] + [marks[k] for k in some]
        b = [y for _, y in span] + [None] * len(some)
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "links": pa.array([0] * len(span) + links[some].tolist(), pa.int64())})

    return members.groupBy("band", "hash", "i", "j").applyInArrow(linked, "a binary, b binary, links bigint")


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, root): every node of ``links`` (a, b) with the least node it is joined to.

    Large-star and small-star steps in turn, until nothing changes; each round ends
    in a written table.  It is an error if that takes more than ``rounds``, if given.  A node with very many links is met by partial minima and a
    join that adaptive execution can split."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "stars")
    seen = None
    for done in count():
        if done == rounds:
            raise RuntimeError(f"classes are not joined after {rounds} rounds")
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(rest.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """(key, class_id, n_links, copy_id) for each row of ``docs``.

    class_id: least key of the rows joined by links, direct or not; n_links: other
    rows at the threshold or above, copies included; copy_id: least key with the
    same n-gram set.  A row without n-grams, or a class without a key, has its own
    key and no links.
    """
    got = join(docs, key, text, params)
    roots = components(got.links)
    named = roots.join(got.classes.withColumnRenamed("mark", "node"), "node")
    # A group may hold a good part of all classes: its members meet its least key in salts.
    least = named.groupBy("root").agg(F.min("id").alias("class_id")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = named.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    grouped = salted.join(least, ["root", "salt"]).select(F.col("node").alias("mark"), "class_id")
    about = (
        got.classes.join(grouped, "mark", "left")
        .join(got.counts, "mark", "left")
        .where("copies > 1 or class_id is not null")
        .select("mark", F.col("id").alias("copy_id"), F.coalesce("class_id", "id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    about = cut(about, "join-about")
    return _by_mark(got.rows, about).select(
        F.col("id").alias(key),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("copy_id", "id").alias("copy_id"),
    )


def _by_mark(rows: DataFrame, about: DataFrame) -> DataFrame:
    """``rows`` with what ``about`` has of their classes, if anything.  A class may hold a good part of
    all rows, so these meet it in salts; rows without n-grams meet nothing."""
    lone = rows.where("mark is null").select(*rows.columns, *[F.lit(None).cast(about.schema[c].dataType).alias(c) for c in about.columns if c != "mark"])
    salted = rows.where("mark is not null").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    dealt = about.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(dealt, ["mark", "salt"], "left").select(*lone.columns).union(lone)


def one_of_each(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``docs``, its columns as they are, with one row of each class: that of the least doc_id, then
    of the least hash of its text, then the least row.  Rows without a doc_id never take the place
    of one that has it, nor it theirs: one of them stays of each class.  Rows without n-grams are
    in no class; of those of one doc_id and text one stays."""
    got = join(docs, params=params)
    roots = components(got.links).withColumnRenamed("node", "mark")
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "h"))).alias("first"), F.min(F.when(F.col("id").isNull(), F.col("h"))).alias("unkeyed")
    own = cut(got.rows.where("mark is not null").groupBy("mark").agg(*least, F.count("*").alias("copies")), "join-least")
    named = own.join(roots, "mark").withColumn("salt", F.pmod(F.xxhash64("mark"), F.lit(SALTS)).cast("int"))
    groups = named.groupBy("root").agg(F.min("first").alias("group_first"), F.min("unkeyed").alias("group_unkeyed"))
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    linked = named.join(groups, ["root", "salt"]).select("mark", "group_first", "group_unkeyed")
    # A row that is alone in its class, and that class in its group, stays.
    leaders = own.join(linked.withColumn("linked", F.lit(True)), "mark", "left").where("copies > 1 or linked")
    leaders = cut(leaders.select("mark", F.coalesce("group_first", "first").alias("first"), F.coalesce("group_unkeyed", "unkeyed").alias("unkeyed")), "join-leaders")
    beyond = F.when(F.col("id").isNull(), F.col("h") != F.col("unkeyed")).otherwise(F.struct("id", "h") != F.col("first"))
    told = _by_mark(got.rows, leaders).select(F.col("id").alias("at_id"), F.col("h").alias("at_h"), F.coalesce(beyond, F.lit(False)).alias("gone"))
    told = told.groupBy("at_id", "at_h").agg(F.first("gone").alias("gone"), (F.count("*") > 1).alias("many")).where("gone or many")
    told = cut(told, "join-told")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("h"))
    kept = rows.join(told, (F.col("h") == F.col("at_h")) & F.col("id").eqNullSafe(F.col("at_id")), "left").where("gone is null or not gone")
    if told.where("many and not gone").isEmpty():
        return kept.select("row.*")
    turn = F.row_number().over(Window.partitionBy("id", "h").orderBy(F.to_json("row")))
    repeated = kept.where("many").withColumn("turn", turn).where("turn = 1")
    return kept.where("many is null or not many").select("row.*").union(repeated.select("row.*"))
