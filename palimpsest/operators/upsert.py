"""Merging new rows into keyed tables, as a join and a rewrite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import bounded

REPLACE, COALESCE, IGNORE = "replace", "coalesce", "ignore"


def upsert(old: DataFrame, new: DataFrame, key: list[str], policy: str = REPLACE, order: Column | None = None, replaced: tuple[str, ...] = ()) -> DataFrame:
    """``old`` with ``new`` merged in by ``key``.

    replace: a new row's columns take the place of the old ones, nulls too; coalesce: only
    where they are not null, but for ``replaced``; ignore: an old row stays.  New rows of
    one key merge first: the last by ``order`` wins (coalesce: of each column the last
    that is not null), and equal or absent orders go by the row itself.  Rows with a null
    in the key are passed over.
    """
    if policy not in (REPLACE, COALESCE, IGNORE):
        raise ValueError(f"unknown policy: {policy}")
    columns = old.columns
    rest = [c for c in columns if c not in key]
    fresh = merged(new.select(*[F.col(c) if c in new.columns else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in columns], *([order.alias("_order")] if order is not None else [])).na.drop(subset=key), key, rest, policy)
    if policy == IGNORE:
        return old.unionByName(fresh.join(old.select(*key), key, "left_anti").select(*columns))
    a, b = old.withColumn("_old", F.lit(True)).alias("o"), fresh.withColumn("_new", F.lit(True)).alias("n")
    both = a.join(b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key], "full_outer")

    def chosen(c: str) -> Column:
        was, now = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c in key or policy == COALESCE and c not in replaced:
            return F.coalesce(now, was).alias(c)
        return F.when(F.col("n._new"), now).otherwise(was).alias(c)

    return both.select(*[chosen(c) for c in columns])


def changes(old: DataFrame, new: DataFrame, key: list[str], policy: str = REPLACE) -> tuple[DataFrame, DataFrame]:
    """(added, changed): one row for each key of ``new`` that ``old`` lacks, and one, as ``upsert``
    leaves it, for each row of ``old`` that it would change.  Neither holds what stays as it is."""
    columns = old.columns
    rest = [c for c in columns if c not in key]
    fresh = merged(new.select(*columns).na.drop(subset=key), key, rest, policy).select(*columns)
    if policy == IGNORE or not rest:
        return fresh.join(bounded(old.select(*key)), key, "left_anti").select(*columns), fresh.limit(0)
    both = fresh.alias("n").join(bounded(old.withColumn("_old", F.lit(True))).alias("o"), [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key], "left")
    chosen = {c: F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")) if policy == COALESCE or c in key else F.col(f"n.{c}") for c in columns}
    differs = F.lit(False)
    for c in rest:
        differs |= ~chosen[c].eqNullSafe(F.col(f"o.{c}"))
    changed = both.where(F.col("o._old") & differs).select(*[v.alias(c) for c, v in chosen.items()])
    return both.where(F.col("o._old").isNull()).select(*[F.col(f"n.{c}") for c in columns]), changed


def merged(new: DataFrame, key: list[str], rest: list[str], policy: str) -> DataFrame:
    """One row a key of a batch."""
    if not rest:
        return new.select(*key).distinct()
    by = [F.col("_order")] if "_order" in new.columns else []
    whole = F.struct(*by, *[F.col(c) for c in rest])
    if policy == COALESCE:
        picks = [F.max(F.when(F.col(c).isNotNull(), F.struct(*by, F.col(c).alias("v")))).getField("v").alias(c) for c in rest]
        return new.groupBy(*key).agg(*picks)
    last = new.groupBy(*key).agg(F.max(whole).alias("last"))
    return last.select(*key, *[F.col(f"last.{c}").alias(c) for c in rest])


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that stand on several rows: none in a sound table."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def dangling(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose reference to a parent leads nowhere."""
    ids = parent.select(F.col(parent_column).alias("_parent")).distinct()
    return df.where(F.col(column).isNotNull()).join(ids, F.col(column) == F.col("_parent"), "left_anti")
