"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fold


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int, text: str = "text"
) -> DataFrame:
    """(h, text, y): documents with a label of 0 or 1 outside the fold ``held_out``:
    at most ``most`` ids, those of the least seeded hash.  An id labelled twice keeps
    its greatest label, one that stands on several rows its least text by hash; null ids
    and labels take no part, and null texts are empty.  ``most`` bounds what is broadcast,
    and the rows that come back."""
    chosen = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (fold("id", folds) != held_out))
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .withColumn("h", F.xxhash64(F.col("id").cast("string"), F.lit(17)))
        .orderBy("h", "id")
        .limit(most)
    )
    rows = docs.select(F.col("doc_id").alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(chosen), F.col("doc") == F.col("id")).select("h", "doc", "text", F.col("y").cast("double").alias("y"))
    least = Window.partitionBy("h", "doc").orderBy(F.xxhash64("text"), "text")
    return rows.withColumn("turn", F.row_number().over(least)).where("turn = 1").select("h", "text", "y")
