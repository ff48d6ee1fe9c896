"""Mixing sources to target weights by Sainte-Lague apportionment.

Equal-token blocks go to the sources by highest quotients of their targets; each
source's blocks are spread over seeded shards in whole numbers, and within a
shard a seeded order of the documents says which blocks are taken.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, of_texts

#: The weights of the sources in turn, the share of all sizes that
#: the mix takes, and how often a source may be taken.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
BLOCK, SEED = 4, 20
_M = 2147483647


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(row, size, source_size, target, taken) for each row, ``row`` being a struct of
    all columns of ``docs``, so that no name clashes.

    size: words of the text, null texts 0.  Sources stand in code-point order, null
    last; targets are shares of the weights, stopped at MOST times a source's size
    with the excess shared out again by weight.  taken: words the mix takes of the
    row, repeats counted, MOST times its size at most.  Rows of one key and size are
    alike to the seeded order.  An empty table gives an empty result; where all
    texts are empty, all targets are 0.
    """
    seeded = _seeded(F.col(key), seed)
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(key).alias("id"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")).alias("s"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        seeded.alias("h"),
    )
    shards = max(1, int(np.ceil(np.sqrt(docs.count()) / 4)))
    base = base.withColumn("shard", ((F.col("h") * 69621 + 12345) % _M % shards).cast("int"))
    cells = cut(base.groupBy("source", "s", "shard").agg(F.sum("size").alias("z")), "mix-cells")
    sources = cut(targets(cells.groupBy("source", "s").agg(F.sum("z").alias("source_size"))), "mix-sources")
    seats = apportion(sources, block)
    by_shard = Window.partitionBy("s").orderBy("shard")
    so_far = by_shard.rowsBetween(Window.unboundedPreceding, 0)
    share = F.col("reached") / F.greatest(F.col("source_size"), F.lit(1))
    # A shard takes MOST times its words at most; what its blocks have beyond goes to the shards
    # after it that have room: all that a source lacks in the end is less than two blocks.
    quotas = (
        cells.drop("source")
        .withColumn("reached", F.sum("z").over(so_far))
        .join(seats, "s")
        .withColumn("over", F.floor(F.col("seats") * share) * block - F.col("reached") * MOST)
        .withColumn("given", F.col("reached") * MOST + F.least(F.lit(0), F.min("over").over(so_far)))
        .withColumn("quota", F.col("given") - F.coalesce(F.lag("given").over(by_shard), F.lit(0)))
        .select("s", "shard", "z", "source_size", "target", "quota")
    )
    order = Window.partitionBy("s", "shard").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = base.join(quotas, ["s", "shard"]).withColumn("start", F.sum("size").over(order) - F.col("size"))
    whole = F.floor(F.col("quota") / F.greatest(F.col("z"), F.lit(1)))
    rest = F.col("quota") - whole * F.col("z") - F.col("start")
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return rows.select("row", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def _seeded(key: Column, seed: int) -> Column:
    """A seeded order of integer keys that any SQL engine can compute alike."""
    x = F.pmod(F.coalesce(key.cast("bigint"), F.lit(-1)), F.lit(_M))
    return (x * 48271 + seed * 7919) % _M


def targets(sizes: DataFrame) -> DataFrame:
    """Add rank and target to one row a source (source, s, source_size).

    Sources are capped in order of size to weight; the level at which the rest
    share what is left, by weight, is the first that its own source can bear.
    """
    all_rows = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    by_bound = Window.orderBy("bound", "rank")
    up_to = by_bound.rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", weight)
        .withColumn("bound", F.col("source_size") * F.lit(float(MOST)) / F.col("weight"))
        .withColumn("place", F.row_number().over(by_bound))
        .withColumn("capped", F.sum("source_size").over(up_to) - F.col("source_size"))
        .withColumn("light", F.sum("weight").over(up_to) - F.col("weight"))
        .withColumn("total", F.sum("source_size").over(all_rows))
        .withColumn("heavy", F.sum("weight").over(all_rows))
    )
    level = (F.col("total") * SHARE - F.col("capped") * MOST) / (F.col("heavy") - F.col("light"))
    found = F.min(F.when(F.col("level") <= F.col("bound"), F.struct("place", "level"))).over(all_rows)
    return (
        ranked.withColumn("level", level)
        .withColumn("found", found)
        .withColumn("target", F.when(F.col("place") < F.col("found.place"), F.col("source_size") * F.lit(float(MOST))).otherwise(F.col("found.level") * F.col("weight")))
        .select("source", "s", "rank", "source_size", "target")
    )


def apportion(sources: DataFrame, block: int) -> DataFrame:
    """Add seats: blocks by the Sainte-Lague method, ties to the earlier source.

    The quotas are target / divisor, rounded, for the divisor that hands out all
    blocks; it is narrowed down by counting seats for many divisors in one pass, so
    that the sources stay in Spark.  Equal quotients at the end go by rank.
    """
    total, n = sources.agg(F.sum("target"), F.count("*")).first()
    blocks = int((total or 0) // block)
    if blocks == 0:
        return sources.withColumn("seats", F.lit(0).cast("bigint"))

    def seats(d: float | Column) -> Column:
        return F.floor(F.col("target") / d + 0.5)

    low, high = total / (blocks + n / 2 + 1), total / max(blocks - n / 2 - 1, 0.25)
    divisor = None
    for _ in range(12):
        tried = np.unique(np.linspace(low, high, 64))
        sums = sources.agg(*[F.sum(seats(F.lit(float(d)))).alias(f"d{i}") for i, d in enumerate(tried)]).first()
        exact = [d for d, got in zip(tried, sums) if got == blocks]
        if exact:
            divisor = float(exact[0])
            break
        low = float(max((d for d, got in zip(tried, sums) if got > blocks), default=low))
        high = float(min((d for d, got in zip(tried, sums) if got < blocks), default=high))
    if divisor is not None:
        return sources.withColumn("seats", seats(F.lit(divisor)))
    given = sources.withColumn("seats", seats(F.lit(high)))
    left = blocks - given.agg(F.sum("seats")).first()[0]
    quotient = F.col("target") / (F.col("seats") * 2 + 1)
    turn = F.row_number().over(Window.orderBy(quotient.desc(), "rank"))
    return given.withColumn("turn", turn).withColumn("seats", F.col("seats") + (F.col("turn") <= left).cast("bigint")).drop("turn")


def mix_quantities(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, size, source_size, target, taken), as ``mixed`` has them."""
    return mixed(docs, key).select(F.col(f"row.{key}").alias(key), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole time a document
    is taken, and one with its first words for what is taken beyond; n_chars follows
    the text.  Documents without words take no part."""

    @F.pandas_udf("string")
    def first_words(texts: pd.Series, most: pd.Series) -> pd.Series:
        """As many words of each text; null texts stay null, and texts of fewer words whole."""
        word = re.compile(WORD)

        def begin(t: str | None, k: int) -> str | None:
            for i, m in enumerate(word.finditer(t or ""), 1):
                if i == k:
                    return t[: m.end()]
            return t

        return pd.Series([begin(t, k) for t, k in zip(texts, most)], dtype=object)

    rows = mixed(of_texts(docs)).where("taken > 0")
    times = F.expr("concat(array_repeat(size, cast(taken div size as int)), filter(array(taken % size), x -> x > 0))")
    rows = rows.withColumn("words", F.explode(times))
    part = F.col("words") < F.col("size")
    rows = rows.withColumn("text", F.coalesce(first_words(F.when(part, F.col("row.text")), F.col("words")), F.col("row.text")))
    changed = {"text": F.col("text"), "n_chars": F.when(part, F.length("text").cast("bigint")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return rows.select(*[(changed[c] if changed.get(c) is not None else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
