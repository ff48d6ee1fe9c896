"""The corpus pipeline: what is poor or toxic goes, one document of each group of near
duplicates stays, sources are mixed to their targets, and the mix is encoded.

Each stage takes all that its predecessor kept.  All but the last return the
columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm import apportion_mix, bpe_codec, ftrl_toxicity, ngram_join, rff_quality
from palimpsest.sources.storage import delete_at_exit, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of label 1, at its threshold of 0.7."""
    model = rff_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rff_quality.score(docs, model, keep=True).where("predicted = 1").select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts not to be toxic."""
    model = ftrl_toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ftrl_toxicity.score(docs, model, keep=True).where("predicted = 0").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the least doc_id of each group joined by five-word n-gram similarity, and one without a doc_id."""
    return ngram_join.one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each whole time a document is taken, one for a part taken."""
    return apportion_mix.mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers and decoded text of every row."""
    return bpe_codec.encode_table(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("encoding", encoding),
]
#: The classifiers and the encoder are beyond SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{scratch(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        delete_at_exit(spark, path)
        docs = spark.read.parquet(path)
    return docs
