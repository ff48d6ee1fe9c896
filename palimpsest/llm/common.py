"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import cut, scratch

__all__ = ["CHUNK", "WORD", "Memo", "arrow_schema", "cut", "fold", "map_rows", "of_texts", "scratch", "slices", "worker_state"]

#: A word is a run of anything but space, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; -1 for a null id, which is in no fold."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % folds, F.lit(-1)).cast("int")


#: Rows, and bytes of texts, that a Python worker turns into objects at a time.
CHUNK, CHUNK_BYTES = 512, 4 << 20
_WORKER: dict = {}


#: Spark's own number of rows in an Arrow batch, and the one for texts.
_BATCH, _TEXTS = "10000", "1000"


def of_texts(docs: DataFrame) -> DataFrame:
    """``docs``, for work on their texts in Python: where the session leaves the size of Arrow batches
    as it is, they become smaller, as a batch of long texts fills the memory beside the heap."""
    conf = docs.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == _BATCH:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _TEXTS)
    return docs


def worker_state(token: str, setup: Callable[[], object]) -> object:
    """What ``setup`` made for ``token`` in this Python worker.  A worker serves many tasks and
    holds one state at a time, so that those of earlier steps take no memory."""
    if _WORKER.get("token") != token:
        _WORKER.clear()
        _WORKER.update(token=token, state=setup())
    return _WORKER["state"]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most CHUNK rows and CHUNK_BYTES of texts (a longer text
    is a part of its own), so that little becomes objects at once."""
    for batch in batches:
        sizes = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(upto, upto[at] + CHUNK_BYTES, "right")) - 1
            stop = min(max(stop, at + 1), at + CHUNK, batch.num_rows)
            yield batch.slice(at, stop - at)
            at = stop


def map_rows(
    df: DataFrame, fn: Callable[..., tuple], columns: list[str], schema: str, setup: Callable[[], object] | None = None
) -> DataFrame:
    """Run ``fn`` over Arrow batches of ``columns``: it gets the optional ``setup()``
    state and one Python list a column, and gives one list an output column.  A Python
    worker makes the state once and uses it for all its tasks of this call."""
    arrow = arrow_schema(df.sparkSession, schema)
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (worker_state(token, setup),) if setup else ()
        for batch in slices(batches):
            got = fn(*state, *(c.to_pylist() for c in batch.columns))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(got, arrow, strict=True)], schema=arrow
            )

    return of_texts(df).select(*columns).mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


class Memo(dict):
    """A dictionary that computes what it lacks.  It holds ``most`` entries in two halves: when
    the young half is full it becomes the old one, whose entries come back as they are used.
    Keys of ``longest`` or more are computed each time."""

    def __init__(self, compute: Callable, most: int, longest: int | None = None) -> None:
        super().__init__()
        self.compute, self.half, self.old, self.longest = compute, most // 2, {}, longest

    def __missing__(self, key):
        if self.longest is not None and len(key) >= self.longest:
            return self.compute(key)
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.half:
            self.old = self.copy()
            self.clear()
        self[key] = value
        return value
