"""Surrogate ids that stay what they are, and their resolution from natural keys."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import cut


#: Rows that every task may be sent.
FEW = 100_000


def bounded(df: DataFrame) -> DataFrame:
    """The right side of a join.  What Spark expects of a compressed table, or of texts made of numbers, is far below
    what they take in memory, and all of it would pass through the driver: beyond FEW rows both sides are shuffled."""
    return df if df.limit(FEW + 1).count() <= FEW else df.hint("merge")


def assign_ids(df: DataFrame, order: list[str], start: int = 0, id_column: str = "id") -> DataFrame:
    """Add ids start + 1, start + 2, ... in the order of ``order``, a key of ``df``.

    Rows are sorted over key ranges, numbered within each, and shifted by the sizes of
    the ranges before: no task sees all rows."""
    spread = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    mark = F.monotonically_increasing_id()
    placed = cut(spread.withColumn("_mark", mark), "ids").withColumn("_part", F.shiftright("_mark", 33)).withColumn("_place", F.col("_mark").bitwiseAND((1 << 33) - 1))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    before = [0, *accumulate(r["n"] for r in sizes)]
    offsets = df.sparkSession.createDataFrame([(r["_part"], before[i]) for i, r in enumerate(sizes)], "_part bigint, _before bigint")
    numbered = placed.join(F.broadcast(offsets), "_part")  # one row a partition
    return numbered.withColumn(id_column, F.col("_before") + F.col("_place") + 1 + start).drop("_mark", "_part", "_place", "_before")


def extend_ids(old: DataFrame, new: DataFrame, key: list[str], id_column: str = "id") -> DataFrame:
    """(key, id) of all keys: the old ones as they are, new ones above the highest."""
    fresh = new.select(*key).distinct().join(bounded(old.select(*key)), key, "left_anti")
    highest = old.agg(F.coalesce(F.max(id_column), F.lit(0))).first()[0]
    kind = old.schema[id_column].dataType
    ids = assign_ids(fresh, key, highest, id_column).withColumn(id_column, F.col(id_column).cast(kind))
    return old.select(*key, id_column).unionByName(ids.select(*key, id_column))


def resolve(rows: DataFrame, ids: DataFrame, on: dict[str, str], as_column: str, keep_missing: bool, id_column: str = "id") -> DataFrame:
    """Add the id that the natural key stands for.  ``on`` maps columns of ``rows`` to those
    of ``ids``; rows without a match stay with a null or go."""
    lookup = ids.select(*[F.col(v).alias(f"_k{i}") for i, v in enumerate(on.values())], F.col(id_column).alias(as_column))
    match = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(on)]
    out = rows.join(bounded(lookup), match, "left" if keep_missing else "inner")
    return out.drop(*[f"_k{i}" for i in range(len(on))])


def misses(rows: DataFrame, ids: DataFrame, on: dict[str, str]) -> int:
    """How many rows have no match."""
    lookup = ids.select(*[F.col(v).alias(f"_k{i}") for i, v in enumerate(on.values())])
    return rows.join(lookup, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(on)], "left_anti").count()
