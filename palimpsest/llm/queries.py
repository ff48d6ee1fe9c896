"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table.  SQL stands beside those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import apportion_mix, bpe_codec, ftrl_toxicity, hilbert_ann, html_consensus, ngram_join, quartile_digest, rff_quality, suffix_tree_lm, token_count


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_consensus.extract_pages(table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe_codec.encode_table(docs, public_tokenizers.path("word_bpe_49k.json"), payload=False)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = ftrl_toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = ftrl_toxicity.score(docs, model)
    return scored.select("doc_id", ftrl_toxicity.held_out().alias("held_out"), "score", "predicted")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = rff_quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = rff_quality.score(docs, model)
    return scored.select("doc_id", rff_quality.held_out().alias("held_out"), "score", "predicted")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile_digest.compare_with_next(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apportion_mix.mix_quantities(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_classes(table(spark, sf_dir, "documents"))


def op9_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.score(table(spark, sf_dir, "documents"))


def op10_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_ann.search(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_token_counts": op2_token_counts,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_fingerprints": op6_fingerprints,
    "op7_mixing": op7_mixing,
    "op8_ngram_join": op8_ngram_join,
    "op9_suffix_tree_lm": op9_suffix_tree_lm,
    "op10_hilbert_ann": op10_hilbert_ann,
}

#: Sainte-Lague seats are the blocks of the highest quotients target / (2 k - 1); a
#: source's seat count is within the number of sources of its rounded share.
OP7_SQL = """
WITH sized AS (
  SELECT doc_id AS id, source, coalesce('s' || source, 'n') AS s,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ((((coalesce(doc_id, -1) % 2147483647) + 2147483647) % 2147483647) * 48271 + 20 * 7919) % 2147483647 AS h,
         greatest(1, ceil(sqrt(count(*) OVER ()) / 4))::BIGINT AS shards
  FROM documents
), docs AS (SELECT *, (h * 69621 + 12345) % 2147483647 % shards AS shard FROM sized),
cells AS (SELECT s, any_value(source) AS source, shard, sum(size)::BIGINT AS z FROM docs GROUP BY s, shard),
ranked AS (
  SELECT s, source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM (SELECT s, any_value(source) AS source, sum(z)::BIGINT AS source_size FROM cells GROUP BY s)
), weighed AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         source_size * 2.0::DOUBLE / CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS bound
  FROM ranked
), levels AS (
  SELECT *, row_number() OVER (ORDER BY bound, rank) AS place,
         ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
           - 2 * (sum(source_size) OVER (ORDER BY bound, rank ROWS UNBOUNDED PRECEDING) - source_size)::DOUBLE)
         / ((sum(weight) OVER ()) - (sum(weight) OVER (ORDER BY bound, rank ROWS UNBOUNDED PRECEDING) - weight))::DOUBLE AS level
  FROM weighed
), found AS (SELECT place AS edge, level AS common FROM levels WHERE level <= bound ORDER BY place LIMIT 1),
targets AS (
  SELECT s, rank, source_size, CASE WHEN place < edge THEN source_size * 2.0::DOUBLE ELSE common * weight END AS target
  FROM levels, found
), totals AS (SELECT sum(target) AS total, floor(sum(target) / 4)::BIGINT AS blocks, count(*) AS n FROM targets),
offers AS (
  SELECT s, rank, k, target / (2 * k - 1) AS quotient
  FROM targets, totals, unnest(generate_series(
    greatest(1, floor(target * blocks / greatest(total, 1))::BIGINT - n),
    floor(target * blocks / greatest(total, 1))::BIGINT + n + 1)) AS u(k)
), sure AS (
  SELECT s, greatest(0, floor(target * blocks / greatest(total, 1))::BIGINT - n - 1) AS base, blocks FROM targets, totals
), won AS (
  SELECT s, row_number() OVER (ORDER BY quotient DESC, rank, k) AS turn FROM offers
), seats AS (
  SELECT sure.s, base + count(won.s) AS seats
  FROM sure LEFT JOIN won ON won.s = sure.s AND turn <= (SELECT any_value(blocks) - sum(base) FROM sure)
  GROUP BY sure.s, base
), reached AS (SELECT *, sum(z) OVER (PARTITION BY s ORDER BY shard ROWS UNBOUNDED PRECEDING) AS upto FROM cells),
wanted AS (
  SELECT s, shard, z, source_size, target, upto, floor(seats * (upto::DOUBLE / greatest(source_size, 1)))::BIGINT * 4 - upto * 2 AS over_room
  FROM reached JOIN seats USING (s) JOIN targets USING (s)
), filled AS (
  SELECT *, upto * 2 + least(0, min(over_room) OVER (PARTITION BY s ORDER BY shard ROWS UNBOUNDED PRECEDING)) AS given FROM wanted
), quotas AS (
  SELECT s, shard, z, source_size, target, given - coalesce(lag(given) OVER (PARTITION BY s ORDER BY shard), 0) AS quota FROM filled
), placed AS (
  SELECT id, d.size, source_size, target, quota, z,
         sum(d.size) OVER (PARTITION BY s, shard ORDER BY h, id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS start
  FROM docs d JOIN quotas USING (s, shard)
)
SELECT id AS doc_id, size, source_size, target,
       (quota // greatest(z, 1) * size
         + greatest(0, least(quota - quota // greatest(z, 1) * z - start, size)))::BIGINT AS taken
FROM placed
"""

ORACLE_SQL: dict[str, str] = {"op7_mixing": OP7_SQL}
