"""Document quality by random Fourier features, ridge regression and isotonic calibration.

Statistics of a document are standardised and mapped by random cosines, which
approximate a Gaussian kernel.  Tasks sum the normal equations over their rows,
Spark adds the sums up, and the driver solves a system of fixed size.  Binned
scores of rows that the ridge has not seen, summed the same way, give the isotonic
calibration.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK, cut, fold, of_texts, slices
from .labelled import labelled_sample

STATISTICS = (
    "log_chars", "log_words", "word_length", "distinct_words", "repeated_next", "commonest_word", "upper", "digits", "signs",
    "space", "log_line", "distinct_lines", "word_ends_in_signs", "lone_signs", "shouted", "beyond_ascii", "sentence_ends",
    "commonest_sign", "repeated_second",
)
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(65, 91)]] = 1
_CLASS[[*range(97, 123)]] = 2
_CLASS[[*range(48, 58)]] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 5
_CLASS[128:192] = 6
_CLASS[192:] = 7


def statistics(text: str | None) -> list[float]:
    """STATISTICS of the whole of ``text``; null is empty, and an empty text has zeros."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text.encode(), np.uint8)
    kinds = np.bincount(_CLASS[raw], minlength=8)
    chars = len(raw) - kinds[6]
    signs = np.bincount(raw[_CLASS[raw] == 5], minlength=256) if kinds[5] else np.zeros(256)
    words = text.split()
    n = max(len(words), 1)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    lines_n = max(len(lines), 1)
    letters = max(kinds[1] + kinds[2] + kinds[7], 1)
    distinct = counts.items()
    ends = sum(k for w, k in distinct if not w[-1].isalnum() and w[-1] not in ".,;:?")
    lone = sum(k for w, k in distinct if not any(map(str.isalnum, w)))
    shouted = sum(k for w, k in distinct if len(w) > 1 and w.isupper())
    stops = sum(k for w, k in distinct if w[-1] in ".?!")
    return [
        np.log1p(chars), np.log1p(len(words)), min((chars - kinds[4]) / n, 40.0), len(counts) / np.sqrt(n), sum(map(eq, words, words[1:])) / n,
        max(counts.values(), default=0) / n, kinds[1] / letters, kinds[3] / chars, kinds[5] / chars,
        kinds[4] / chars, np.log1p(chars / lines_n), len(set(lines)) / lines_n, ends / n, lone / n, shouted / n, kinds[7] / chars, stops / n,
        signs.max() / chars, sum(map(eq, words, words[2:])) / n,
    ]


@dataclass(frozen=True)
class Params:
    """``sample`` bounds the labelled rows that are learnt from; one in ``calibrate`` of them
    calibrates and is not fitted on."""

    features: int = 256
    width: float = 3.0
    ridge: float = 1e-3
    sample: int = 20_000
    calibrate: int = 4
    bins: int = 512
    seed: int = 11


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    coefficients: np.ndarray
    edges: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.coefficients[:-1] + self.coefficients[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.margin(x), self.edges, self.values)


_UNIT = 2.0**32


def _table(texts: list) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(STATISTICS))


def _sums(rows: DataFrame, fn, size: int) -> np.ndarray:
    """``fn`` of (statistics, labels) gives one vector of ``size`` a task; their sum,
    added up by Spark position by position before it reaches the driver.  Sums are
    rounded to 2 ** -32 and added up as integers, so that no order of tasks changes them."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        seen = False
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch["x"].values.to_numpy()).reshape(batch.num_rows, -1)
                total += fn(x, batch["y"].to_numpy())
                seen = True
        if seen:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.rint(total[at] * _UNIT).astype(np.int64))], names=["at", "v"])

    got = rows.mapInArrow(summed, "at int, v bigint").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[got["at"].to_numpy()] = got["v"].to_numpy() / _UNIT
    return out


def isotonic(weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The non-decreasing values nearest to ``mean`` by weighted squares (pool adjacent violators)."""
    pools: list[list[float]] = []
    for w, m in zip(weight.tolist(), mean.tolist()):
        pools.append([w, m, 1])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            w2, m2, k2 = pools.pop()
            w1, m1, k1 = pools.pop()
            pools.append([w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), k1 + k2])
    return np.repeat([p[1] for p in pools], [int(p[2]) for p in pools])


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """Learn from the bounded sample of rows outside the held-out fold.  Without any,
    every score is 0.5."""
    sample = labelled_sample(of_texts(docs), labels, "quality", 4, 2, params.sample)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = _table(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["h"], pa.array(list(x), pa.list_(pa.float64())), batch["y"]], names=["h", "x", "y"])

    # One file, in one order: a task's sums are the same in every run.
    measures = sample.select("h", "text", "y").mapInArrow(measured, "h bigint, x array<double>, y double")
    every = cut(measures.repartition(1).sortWithinPartitions("h", "x"), "quality-sample")
    aside = F.pmod(F.xxhash64("h"), F.lit(params.calibrate)) == 0
    rows, unseen = every.where(~aside).select("x", "y"), every.where(aside).select("x", "y")
    d, m = len(STATISTICS), params.features
    moments = _sums(rows, lambda x, y: np.concatenate([[len(y)], x.sum(0), (x * x).sum(0)]), 1 + 2 * d)
    n = moments[0]
    mean = moments[1 : d + 1] / max(n, 1)
    scale = np.sqrt(np.maximum(moments[d + 1 :] / max(n, 1) - mean**2, 1e-12))
    rng = np.random.default_rng(params.seed)
    model = Model(mean, np.where(scale > 1e-5, scale, 1.0), rng.normal(size=(d, m)) / params.width, rng.uniform(0, 2 * np.pi, m), np.zeros(m + 1), np.zeros(1), np.full(1, 0.5))
    if n == 0:
        return model

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = np.hstack([model.features(x), np.ones((len(y), 1))])
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _sums(rows, normal, (m + 1) ** 2 + m + 1)
    left = sums[: (m + 1) ** 2].reshape(m + 1, m + 1) + np.diag([params.ridge * n] * m + [0.0]) / m
    model.coefficients = np.linalg.solve(left, sums[(m + 1) ** 2 :])
    bins = params.bins

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(((model.margin(x) + 0.5) / 2 * bins).astype(int), 0, bins - 1)
        return np.concatenate([np.bincount(at, minlength=bins), np.bincount(at, y, bins)])

    counts = _sums(unseen, binned, 2 * bins)
    if not counts.any():  # a sample too small to set rows aside
        counts = _sums(rows, binned, 2 * bins)
    weight, ones = counts[:bins], counts[bins:]
    used = np.flatnonzero(weight)
    model.edges = (used + 0.5) / bins * 2 - 0.5
    model.values = isotonic(weight[used], ones[used] / weight[used])
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = 0.7, keep: bool = False) -> DataFrame:
    """(key, score, predicted) for each row; with ``keep``, all columns of ``docs`` and the two.

    The score is the calibrated probability of label 1; null and empty texts have
    zero statistics and are scored like any other.  Predicted is 1 from ``threshold``
    on.  Repeated rows give a row each, an empty table none.  Clashing columns named
    score or predicted are replaced; the others are left aside, or kept as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        # A few hundred texts at a time: a batch may hold very many, or very long ones.
        parts = [shared.value.score(_table(texts.slice(i, CHUNK).to_pylist())) for i in range(0, len(texts), CHUNK)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0))

    docs = of_texts(docs)
    value = scored(F.col(text).cast("string"))
    base = docs.withColumn("score", value) if keep else docs.select(F.col(key).alias(key), value.alias("score"))
    return base.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(key: str = "doc_id") -> Column:
    return fold(key, 4) == 2
