"""Deduplication with results that do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import IDENTITY, STAGED


def distinct_rows(df: DataFrame, required: tuple[str, ...] = ()) -> DataFrame:
    """Full-row distinct of the rows whose required columns are there; summed up before the shuffle."""
    return df.na.drop(subset=list(required)).distinct() if required else df.distinct()


def _null_last(columns: list[str]) -> Column:
    """A struct that orders rows column by column, nulls after values."""
    parts = []
    for c in columns:
        parts += [F.col(c).isNull().alias(f"{c}_null"), F.col(c)]
    return F.struct(*parts)


def representative(df: DataFrame, key: tuple[str, ...], required: tuple[str, ...] = (), whole: bool = True) -> DataFrame:
    """One row a key.  ``whole``: the least row, nulls after values, as it stands; else
    each column's least value that is not null."""
    rows = df.na.drop(subset=list(required)) if required else df
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return rows.select(*key).distinct()
    if not whole:
        return rows.groupBy(*key).agg(*[F.min(c).alias(c) for c in rest]).select(*df.columns)
    least = rows.groupBy(*key).agg(F.min(_null_last(rest)).alias("least"))
    return least.select(*[F.col(c) if c in key else F.col(f"least.{c}").alias(c) for c in df.columns])


def required_rows(df: DataFrame, table: str) -> DataFrame:
    """The rows whose columns that a staged table requires are there."""
    return df.na.drop(subset=list(IDENTITY[table].required)) if IDENTITY[table].required else df


def dedup_table(df: DataFrame, table: str) -> DataFrame:
    """A staged table by its own key and required columns."""
    if table not in STAGED:
        raise ValueError(f"unknown table: {table}")
    identity = IDENTITY[table]
    if set(identity.key) == set(df.columns):
        return distinct_rows(df, identity.required)
    return representative(df, identity.key, identity.required, identity.whole)


def hash_partition(columns: list[Column], parts: int) -> Column:
    """The part of a key: MD5 of its texts joined by a zero, first four bytes as a
    little-endian number, modulo ``parts``; a null counts as the text None."""
    text = F.concat_ws("\x00", *[F.coalesce(c.cast("string"), F.lit("None")) for c in columns])
    digest = F.md5(text.cast("binary"))
    little = F.concat(*[F.substring(digest, i, 2) for i in (7, 5, 3, 1)])
    return (F.conv(little, 16, 10).cast("bigint") % parts).cast("int")


def parts_for(rows: int, rows_a_part: int = 5_000_000) -> int:
    """As many parts as rows need, rounded up to a power of two."""
    needed = max(1, -(-rows // rows_a_part))
    return 1 << (needed - 1).bit_length()


def consolidate(*tables: DataFrame) -> DataFrame:
    """All rows of tables of one kind, repeats kept."""
    out = tables[0]
    for df in tables[1:]:
        out = out.unionByName(df)
    return out
