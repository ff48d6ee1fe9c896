"""Document fingerprints as quartile bucket digests.

Byte triplets of the whole text are hashed into buckets and counted; each bucket
is coded by the quartile of its count, beside a code of the length and of the
quartiles' proportions.  Two digests compare by a bounded difference score.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, of_texts, slices

BUCKETS = 256
#: What two unrelated texts differ by on average, or more: likeness 0.
UNRELATED = 1.625 * BUCKETS
_LOW = -(2**63)


def fingerprint(raw: bytes) -> np.ndarray:
    """The digest as bytes: length code, proportions of the quartiles, two bits a bucket."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) >= 3:
        key = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
        counts = np.bincount(key * np.uint32(2654435761) >> np.uint32(24), minlength=BUCKETS)
    else:
        # Too short for a triplet: what there is, at a place of its own.
        counts = np.zeros(BUCKETS, np.int64)
        counts[[int(x) for x in b]] = 1
    q1, q2, q3 = np.partition(counts, (BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1))[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).astype(np.uint8).reshape(-1, 4)
    length = min(255, int(np.log1p(len(raw)) / np.log(1.1)))
    top = max(int(q3), 1)
    ratios = (int(q1) * 15 // top) << 4 | (int(q2) * 15 // top)
    packed = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return np.concatenate([np.array([length, ratios], np.uint8), packed.astype(np.uint8)])


def _pair_costs() -> np.ndarray:
    """Differences of two bytes of four codes each; opposite quartiles count double."""
    step = np.array([[abs(a - b) if abs(a - b) < 3 else 6 for b in range(4)] for a in range(4)])
    byte = np.arange(256)
    return sum(step[(byte[:, None] >> s & 3), (byte[None, :] >> s & 3)] for s in (0, 2, 4, 6)).astype(np.uint16)


_COSTS = _pair_costs()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal digests, falling with their difference to 0; the difference is
    bounded by UNRELATED."""
    body = int(_COSTS[a[2:], b[2:]].sum())
    head = abs(int(a[0]) - int(b[0])) + abs((int(a[1]) >> 4) - (int(b[1]) >> 4)) + abs((int(a[1]) & 15) - (int(b[1]) & 15))
    return 1.0 - min(body + head, UNRELATED) / UNRELATED


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _edges(o: np.ndarray, h: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and hashes that part a sample into ranges of like size."""
    by = np.lexsort((h, o))
    at = by[(np.arange(1, ranges) * len(by) // ranges)] if len(by) else by
    o, h = o[at], h[at]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    return o[new], h[new]


def _ranges(edges: tuple[np.ndarray, np.ndarray], o: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How many edges come before each pair of key and hash."""
    low, high = np.searchsorted(edges[0], o, "left"), np.searchsorted(edges[0], o, "right")
    out = low.astype(np.int32)
    for a in np.unique(low[high > low]):
        at = np.flatnonzero((low == a) & (high > low))
        out[at] += np.searchsorted(edges[1][a : high[at[0]]], h[at], "left").astype(np.int32)
    return out


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The next row is the next in ascending order of the integer ``key``, after the
    last the first; rows of one key follow each other by the text's hash; a null key
    comes first.  Null texts are empty.  A lone row is its own next.  Other columns
    are left aside, whatever their names; an empty table gives an empty result.

    Rows go once over the network, to about sqrt(n) ranges of key and hash, so that rows of
    one key may be in many; the first row of each range also goes to the end of the range
    before.  What the driver holds is some keys a range.
    """
    spark = of_texts(docs).sparkSession
    order = F.coalesce(F.col(key).cast("bigint"), F.lit(_LOW)).alias("o")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    ids = docs.select(order, F.xxhash64(body).alias("h"))
    n = docs.count()
    ranges = max(1, int(np.ceil(np.sqrt(n))))
    share = min(1.0, 32 * ranges / max(n, 1))
    seen = ids.where(F.pmod(F.xxhash64("o", "h", F.lit(1)), F.lit(1 << 20)) <= int(share * (1 << 20))).toArrow()
    edges = _edges(seen["o"].to_numpy(), seen["h"].to_numpy(), ranges)

    @F.pandas_udf("int")
    def range_of(o: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series(_ranges(edges, o.to_numpy(), h.to_numpy()))

    firsts = ids.groupBy(range_of("o", "h").alias("r")).agg(F.min(F.struct("o", "h")).alias("f")).select("r", "f.*").orderBy("r").toArrow()
    used = firsts["r"].to_numpy()
    before = dict(zip(zip(firsts["o"].to_pylist(), firsts["h"].to_pylist()), np.roll(used, 1).tolist()))

    @F.pandas_udf("array<int>")
    def places(o: pd.Series, h: pd.Series) -> pd.Series:
        own = _ranges(edges, o.to_numpy(), h.to_numpy()).tolist()
        return pd.Series([[r, before[x]] if x in before else [r] for r, x in zip(own, zip(o.tolist(), h.tolist()))])

    rows = docs.select(order, F.col(key).alias("k"), body.alias("t"), F.xxhash64(body).alias("h"))
    rows = rows.select("o", "k", "t", "h", F.posexplode(places("o", "h")).alias("guest", "r"))
    rows = rows.repartition("r").sortWithinPartitions("r", "guest", "o", "h")
    kind = docs.schema[key].dataType.simpleString()
    ddl = f"k {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    arrow = arrow_schema(spark, ddl)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # key, text and digest of the row that waits for its next
        at = None
        for batch in slices(batches):
            out: list[tuple] = []
            for k, t, r, guest in zip(batch["k"].to_pylist(), batch["t"].to_pylist(), batch["r"].to_pylist(), batch["guest"].to_pylist()):
                if held is None and guest and r == at:
                    continue  # a further row of the guest's key
                mark = fingerprint(t.encode())
                if held is not None and r == at:
                    own, body, digest = held
                    new = edited(body, t).encode()
                    mark2 = fingerprint(new)
                    out.append((own, len(body), hashlib.sha256(new).hexdigest(), digest.tobytes().hex(), mark2.tobytes().hex(), likeness(digest, mark2), likeness(digest, mark)))
                held, at = (None if guest else (k, t, mark)), r
            columns = list(zip(*out)) or [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.select("k", "t", "r", "guest").mapInArrow(compared, ddl).withColumnRenamed("k", key)
