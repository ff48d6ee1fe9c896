"""Approximate nearest neighbours along shifted Hilbert curves.

Vectors are projected several times at random, shifted, and ordered along a Hilbert
curve.  Spark deals the rows of each ordering into key ranges; a query goes to its
own range and to those beside it, each of which reranks its rows by the true
distance, and the candidates of all windows and orderings merge.  How many orderings
and how wide the windows are is fitted on a sample, for the recall asked for at the
least work.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

_LOW = 12


@dataclass(frozen=True)
class Params:
    """``sample`` vectors fit the projections, the levels, the number of orderings, from
    ``least`` to ``curves``, and the width of the windows: the least share of an ordering
    that finds ``recall`` of the sample's own neighbours.  ``move``: what bringing a row to
    a window costs, in comparisons.  ``range_rows`` rows make a key range, of which there
    are ``ranges`` at least; ``part`` bounds the queries that meet one in a task."""

    curves: int = 10
    least: int = 2
    dims: int = 5
    bits: int = 9
    sample: int = 4096
    probes: int = 256
    recall: float = 0.97
    move: int = 200
    range_rows: int = 8192
    ranges: int = 16
    part: int = 1 << 18
    seed: int = 5


def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Places along a Hilbert curve of rows of unsigned integers below 2 ** bits
    (Skilling's transposition, for all rows at once)."""
    x = x.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


@dataclass
class Curves:
    """Projections, level edges by projection, and shifts of every curve; window: share of
    an ordering on either side of a query."""

    directions: np.ndarray
    edges: np.ndarray
    shifts: np.ndarray
    bits: int
    window: float

    def keys(self, x: np.ndarray) -> np.ndarray:
        """One column of keys a curve."""
        curves, dims = self.shifts.shape
        y = x @ self.directions
        out = np.empty((len(x), curves), np.int64)
        for c in range(curves):
            cell = np.stack([np.searchsorted(self.edges[c * dims + i], y[:, c * dims + i]) for i in range(dims)], axis=1)
            out[:, c] = hilbert_keys(cell + self.shifts[c], self.bits + 1)
        return out


def fit(sample: np.ndarray, params: Params, k: int, asked: int = 0) -> Curves:
    """Curves for the vectors that ``sample`` stands for, of which ``asked`` are queries."""
    rng = np.random.default_rng(params.seed)
    d = sample.shape[1]
    total = params.curves * params.dims
    directions = np.concatenate([np.linalg.qr(rng.normal(size=(d, params.dims)))[0] if d >= params.dims else rng.normal(size=(d, params.dims)) for _ in range(params.curves)], axis=1)
    y = sample @ directions
    levels = np.linspace(0, 1, (1 << params.bits) + 1)[1:-1]
    edges = np.quantile(y, levels, axis=0).T.reshape(total, -1)
    shifts = rng.integers(0, 1 << params.bits, (params.curves, params.dims))
    every = Curves(directions, edges, shifts, params.bits, 0.5)
    ranks = np.argsort(np.argsort(every.keys(sample), axis=0, kind="stable"), axis=0)
    probes = np.arange(min(params.probes, len(sample)))
    apart = distances(sample[probes], sample)
    apart[probes, probes] = np.inf
    near = np.argsort(apart, axis=1, kind="stable")[:, : min(k, max(len(sample) - 1, 1))]
    gap = np.minimum.accumulate(np.abs(ranks[near] - ranks[probes][:, None, :]), axis=2) / max(len(sample) - 1, 1)
    windows = np.quantile(gap, params.recall, axis=(0, 1))
    # What lies within a window of an ordering's length, on the average of all places.
    work = np.arange(1, params.curves + 1) * (params.move + asked * (2 * windows - windows**2))
    n = params.least + int(np.argmin(work[params.least - 1 :]))
    return Curves(directions[:, : n * params.dims], edges[: n * params.dims], shifts[:n], params.bits, float(windows[n - 1]))


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances by products: quick, and near enough to choose by."""
    return np.sqrt(np.maximum((q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * q @ x.T, 0))


def nearest_in(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query, ids and exact distances of its k nearest rows, ties to smaller ids."""
    out = []
    for start in range(0, len(q), 256):
        part = q[start : start + 256]
        rough = distances(part, x)
        kth = np.partition(rough, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
        slack = kth + 1e-6 * (1 + np.sqrt((part * part).sum(1)))
        for row, bound, v in zip(rough, slack, part):
            at = np.flatnonzero(row <= bound)
            exact = np.sqrt(((x[at] - v) ** 2).sum(axis=1))
            order = np.lexsort((ids[at], exact))[:k]
            out.append((ids[at][order], exact[order]))
    return out


def search(
    vectors: DataFrame, k: int = 10, every: int = 100, key: str = "vec_id", vector: str = "embedding", params: Params = Params()
) -> DataFrame:
    """(query_id, rank, key, score): the ``k`` nearest found of each row whose key is divisible by ``every``.

    Vectors that are null or all zeros, or that hold null or non-finite components, take
    no part, and neither do rows without a key.  Vectors of each length are searched
    apart, as there is no distance between lengths.  Rows with the query's own key are no
    candidates; rows that repeat key and vector count once.  Of equal vectors the
    k + 1 smallest keys suffice, so a vector that a third of all rows share is no
    burden.  Other columns are left aside; an empty table gives an empty result.
    """
    kind = vectors.schema[key].dataType.simpleString()
    of = vectors.schema[vector].dataType.simpleString()
    column = F.col(vector) if of == "array<float>" else F.col(vector).cast("array<double>")
    fine = F.expr("v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x <> 0)")
    rows = vectors.select(F.col(key).alias("id"), column.alias("v")).where("id is not null").where(fine)
    lengths = sorted(r[0] for r in rows.select(F.size("v")).distinct().collect())
    if not lengths:
        return vectors.sparkSession.createDataFrame([], f"query_id {kind}, rank int, {key} {kind}, score double")
    found = reduce(DataFrame.union, [_found(rows.where(F.size("v") == n), n, k, every, params) for n in lengths])
    return found.select(F.col("query").cast(kind).alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("near").cast(kind).alias(key), F.col("d").alias("score"))


def _matrix(column: pa.ListArray | pa.ChunkedArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _found(rows: DataFrame, width: int, k: int, every: int, params: Params) -> DataFrame:
    """(query, rank, near, d) of rows (id, v) with vectors of one length."""
    spark = rows.sparkSession
    # Equal vectors: the smallest keys; the limit holds before the shuffle as well.
    same = Window.partitionBy("v").orderBy("id")
    base = cut(rows.distinct().withColumn("turn", F.row_number().over(same)).where(F.col("turn") <= k + 1), "ann-rows")
    asked = rows.where(F.col("id") % every == 0).distinct()
    points = cut(asked.groupBy("v").agg(F.min("id").alias("id")), "ann-queries")
    n, queries = base.count(), points.count()
    # Fitted on vectors that differ: copies find each other in any window.
    unlike = base.where("turn = 1").orderBy(F.xxhash64("v"), "id").limit(params.sample).select("v").toArrow()["v"].combine_chunks()
    curves = fit(_matrix(unlike, width), params, k, queries)
    shared = spark.sparkContext.broadcast(curves)

    @F.arrow_udf("array<bigint>")
    def keys(v: pa.Array, mark: pa.Array) -> pa.Array:
        low = (mark.to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _LOW)).astype(np.int64)
        got = shared.value.keys(_matrix(v, width)) << _LOW | low[:, None]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1) * got.shape[1], pa.int32()), pa.array(got.ravel()))

    base, points = (x.select("id", "v", F.posexplode(keys("v", F.xxhash64("id"))).alias("c", "key")) for x in (base, points))
    # The driver sees some keys of each range, to cut the ranges by.
    ranges = max(-(-n // params.range_rows), min(params.ranges, -(-n // 512)))
    share = min(1.0, 64 * ranges / n)
    seen = base.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 20)) <= int(share * (1 << 20))).select("c", "key").toArrow()
    c, at = seen["c"].to_numpy(), seen["key"].to_numpy()
    marks = np.arange(1, ranges) / ranges
    edges = spark.sparkContext.broadcast([np.quantile(own, marks, method="nearest") if len(own := at[c == i]) else np.zeros(ranges - 1, np.int64) for i in range(len(curves.shifts))])

    @F.arrow_udf("int")
    def range_of(c: pa.Array, key: pa.Array) -> pa.Array:
        curve, value = c.to_numpy(), key.to_numpy()
        out = np.zeros(len(curve), np.int32)
        for x in np.unique(curve):
            out[curve == x] = np.searchsorted(edges.value[x], value[curve == x])
        return pa.array(out)

    reach = max(1, int(np.ceil(curves.window * ranges)))
    parts = max(1, int(np.ceil(queries * min(1.0, (2 * reach + 1) / ranges) / params.part)))
    spread = base.select("c", range_of("c", "key").alias("r"), F.lit(False).alias("query"), "id", "v")
    spread = spread.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    windows = points.select("c", range_of("c", "key").alias("own"), F.lit(True).alias("query"), "id", "v")
    windows = windows.withColumn("r", F.explode(F.sequence(F.greatest(F.col("own") - reach, F.lit(0)), F.least(F.col("own") + reach, F.lit(ranges - 1)))))
    windows = windows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    columns = ["c", "r", "part", "query", "id", "v"]
    met = spread.select(*columns).union(windows.select(*columns)).repartition("c", "r", "part").sortWithinPartitions("c", "r", "part", "query")

    def reranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A range's rows come first and are held; queries come after them and pass by."""
        held, rows, ids = None, [], []
        for batch in batches:
            place = np.stack([batch[x].to_numpy() for x in ("c", "r", "part")], axis=1)
            asks = batch["query"].to_numpy(zero_copy_only=False)
            x, own = _matrix(batch["v"], width), batch["id"].to_numpy()
            new = np.any(place[1:] != place[:-1], axis=1) | (asks[1:] != asks[:-1])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(place)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held != (at := tuple(place[a])):
                    held, rows, ids = at, [], []
                if not asks[a]:
                    rows.append(x[a:b])
                    ids.append(own[a:b])
                elif rows:
                    rows, ids = [np.concatenate(rows)], [np.concatenate(ids)]
                    got = nearest_in(x[a:b], rows[0], ids[0], k + 1)
                    columns = np.repeat(own[a:b], [len(i) for i, _ in got]), np.concatenate([i for i, _ in got]), np.concatenate([d for _, d in got])
                    yield pa.RecordBatch.from_arrays([pa.array(y) for y in columns], names=["q", "id", "d"])

    near = met.mapInArrow(reranked, "q bigint, id bigint, d double").distinct()
    best = Window.partitionBy("q").orderBy("d", "id")
    near = near.withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= k + 1).select("q", F.col("id").alias("near"), "d")
    # Back to every query: those of one vector share what was found.
    members = asked.join(asked.groupBy("v").agg(F.min("id").alias("q")), "v").select("q", F.col("id").alias("query"))
    own = Window.partitionBy("query").orderBy("d", "near")
    return members.join(near, "q").where("near <> query").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).select("query", "rank", "near", "d")
