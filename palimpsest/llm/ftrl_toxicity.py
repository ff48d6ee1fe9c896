"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Every coordinate has its own learning rate, and the L1 term keeps most weights at
zero, so the weights that are left are few and of bounded number (``2 ** bits``):
small enough to broadcast to the tasks that score.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK, Memo, fold, map_rows, of_texts, worker_state
from .labelled import labelled_sample

_EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~¡¿«»…“”‘’"


@dataclass(frozen=True)
class Params:
    """``sample`` bounds the labelled rows that are learnt from; one task learns from all of them."""

    bits: int = 20
    sample: int = 20_000
    epochs: int = 6
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0


class Features:
    """Distinct hashed words, word pairs, and pairs that skip one word, of whole texts."""

    def __init__(self, bits: int, memo: int = 300_000) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.words = Memo(lambda w: xxhash.xxh3_64_intdigest(w.lower().strip(_EDGES)), memo)

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        w = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        pairs = w[:-1] * np.uint64(0x9E3779B97F4A7C15) + w[1:]
        skips = w[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + w[2:]
        every = np.concatenate([w, pairs ^ (pairs >> np.uint64(29)), skips ^ (skips >> np.uint64(31))])
        return np.unique(every & self.mask).astype(np.int32)


@dataclass
class Model:
    """The weights that are not zero, and the bias."""

    at: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.at] = self.weight
        return out


def train(examples: list[tuple[np.ndarray, float]], params: Params) -> Model:
    """FTRL-proximal over ``examples`` (places of features that are there, label) in the given
    order, ``epochs`` times.

    The bias is the last coordinate, without L1.  No examples: all weights 0.  A text
    without features moves the bias alone."""
    size = 1 << params.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(params.epochs):
        for features, y in examples:
            at = np.append(features, size)
            w = _weights(z[at], n[at], params)
            w[-1] = -z[size] / ((params.beta + np.sqrt(n[size])) / params.alpha)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - y
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / params.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = _weights(z, n, params)
    bias = -z[size] / ((params.beta + np.sqrt(n[size])) / params.alpha)
    at = np.flatnonzero(w[:size])
    return Model(at.astype(np.int32), w[at].astype(np.float32), float(bias), params.bits)


def _weights(z: np.ndarray, n: np.ndarray, params: Params) -> np.ndarray:
    """Weights of coordinates by their sums: 0 as long as z is within L1."""
    w = (np.sign(z) * params.l1 - z) / ((params.beta + np.sqrt(n)) / params.alpha + params.l2)
    return np.where(np.abs(z) <= params.l1, 0.0, w)


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """Learn from the bounded sample of rows outside the held-out fold.

    Tasks make the features; one takes them all, in the order of the ids' hashes, learns, and
    gives the weights that are not zero: nothing else reaches the driver."""
    sample = labelled_sample(docs, labels, "toxic", 5, 0, params.sample)

    def featurised(features: Features, hashes: list, texts: list, ys: list) -> tuple:
        return hashes, [features.of(t).tobytes() for t in texts], ys

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, cuts, ys = [np.zeros(0, np.int32)], [0], []
        for batch in batches:
            f = batch["f"].cast(pa.binary())
            ends = np.frombuffer(f.buffers()[1], np.int32)[f.offset : f.offset + len(f) + 1] // 4
            parts.append(np.frombuffer(f.buffers()[2] or b"", np.int32)[ends[0] : ends[-1]].copy())
            cuts += (ends[1:].astype(np.int64) - int(ends[0]) + cuts[-1]).tolist()
            ys += batch["y"].to_pylist()
        flat = np.concatenate(parts)
        parts.clear()
        model = train([(flat[a:b], y) for a, b, y in zip(cuts, cuts[1:], ys)], params)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(model.at, -1).astype(np.int32)), pa.array(np.append(model.weight.astype(np.float64), model.bias))], names=["at", "w"])

    rows = map_rows(sample, featurised, ["h", "text", "y"], "h bigint, f binary, y double", lambda: Features(params.bits))
    got = rows.repartition(1).sortWithinPartitions("h", "f").select("f", "y").mapInArrow(learnt, "at int, w double").toArrow()
    if not got.num_rows:  # without rows there may be no task
        return train([], params)
    at, w = got["at"].to_numpy(), got["w"].to_numpy()
    return Model(at[:-1].astype(np.int32), w[:-1].astype(np.float32), float(w[-1]), params.bits)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """(key, score, predicted) for each row; with ``keep``, all columns of ``docs`` and the two.

    The score is the probability of label 1; null and empty texts have no features and
    score by the bias.  Predicted is 1 from a score of 0.5 on.  Repeated rows give a
    row each, an empty table none.  Clashing columns named score or predicted are
    replaced; the others are left aside, or kept as they are.
    """
    shared, token = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        features, weights = worker_state(token, lambda: (Features(shared.value.bits), shared.value.dense()))
        margins = np.empty(len(texts))
        for i in range(0, len(texts), CHUNK):
            for k, t in enumerate(texts.slice(i, CHUNK).to_pylist(), i):
                margins[k] = weights[features.of(t)].sum(dtype=np.float64) + shared.value.bias
        return pa.array(1 / (1 + np.exp(-np.clip(margins, -35, 35))))

    docs = of_texts(docs)
    value = scored(F.col(text).cast("string"))
    base = docs.withColumn("score", value) if keep else docs.select(F.col(key).alias(key), value.alias("score"))
    return base.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(key: str = "doc_id") -> Column:
    return fold(key, 5) == 0
