"""Awkward documents that every operator must take: nulls in any column, empty, blank and
very long texts, repeated rows and ids, special strings, and columns whose names clash."""

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TINY = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the cat sat on a mat and then it ran off to see what the dog had done with its own bone in the yard"


def awkward_rows():
    long = " ".join(f"w{i % 997}" for i in range(20_000))
    rows = [
        (1, WORDS, "en", "b"), (2, WORDS, "en", "b"), (2, WORDS, "en", "b"), (3, None, "en", "a"), (4, "", None, None), (5, " \t\n ", "de", "a"),
        (None, WORDS + " again", "en", None), (6, long, "en", "c"), (7, "x" * 30_000, "en", "c"), (8, "<|endoftext|> ÄÖ ß 你好 😀 don't  \n\n x<|startoftext|>", None, "c"),
        (9, "one", "en", "Z"), (9, "two words", "en", "Z"), (10, "ΑΣ İ ǅ é   \x85 \x1c", "el", "ä"), (None, None, None, None),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    for name in ("score", "predicted", "size", "row", "target", "k", "t", "id", "mark", "h", "s", "u", "f", "o", "r", "v"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
