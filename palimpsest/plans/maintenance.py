"""Creating, truncating and dropping served tables, and the layout of the large ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import dangling, duplicate_keys
from ..schemas import SERVED
from ..sources.storage import delete, empty, exists, read_table, replace_table

#: Children first: the order to drop and truncate in.
CHILDREN_FIRST = (
    "template_data", "wiki_templates", "normalized_citation_web_resources", "citation_history", "revisions",
    "revision_bundles", "citation_instances", "normalized_citations", "web_resources", "documents", "domains", "containers",
)
KEYS = {
    "containers": ["label"], "domains": ["value"], "documents": ["has_container", "page_id"], "web_resources": ["url_hash"],
    "normalized_citations": ["normalized_sha1"], "citation_instances": ["page_id", "raw_sha1"], "revisions": ["revision_id"],
    "citation_history": ["citation_instance_id", "revision_id"], "normalized_citation_web_resources": ["normalized_id", "web_resource_id"],
    "wiki_templates": ["domain_id", "name"], "template_data": ["wiki_template_id", "normalized_id", "offset_start", "parameter_key_md5"],
    "revision_bundles": ["file_path"],
}
PARENTS = {
    ("domains", "for_container"): ("containers", "id"), ("web_resources", "domain_id"): ("domains", "id"),
    ("web_resources", "instance_of_document"): ("documents", "id"), ("normalized_citations", "appears_on_article"): ("documents", "id"),
    ("citation_instances", "normalized_id"): ("normalized_citations", "id"), ("citation_history", "citation_instance_id"): ("citation_instances", "id"),
    ("citation_history", "revision_id"): ("revisions", "revision_id"), ("wiki_templates", "domain_id"): ("domains", "id"),
    ("normalized_citation_web_resources", "normalized_id"): ("normalized_citations", "id"),
    ("normalized_citation_web_resources", "web_resource_id"): ("web_resources", "id"),
    ("template_data", "wiki_template_id"): ("wiki_templates", "id"), ("template_data", "normalized_id"): ("normalized_citations", "id"),
}


def _named(table: str | None) -> tuple[str, ...]:
    if table is not None and table not in SERVED:
        raise ValueError(f"unknown table: {table}")
    return CHILDREN_FIRST if table is None else (table,)


def create(spark: SparkSession, root: str, table: str | None = None) -> list[str]:
    """Write empty tables where there are none; gives the names of the new ones."""
    new = [name for name in reversed(_named(table)) if not exists(spark, f"{root}/{name}")]
    for name in new:
        empty(spark, SERVED[name]).write.parquet(f"{root}/{name}")
    return new


def truncate(spark: SparkSession, root: str, table: str | None = None) -> None:
    for name in _named(table):
        if exists(spark, f"{root}/{name}"):
            replace_table(empty(spark, SERVED[name]), f"{root}/{name}")


def drop(spark: SparkSession, root: str, table: str | None = None) -> None:
    for name in _named(table):
        delete(spark, f"{root}/{name}")


def violations(spark: SparkSession, root: str) -> DataFrame:
    """(check, n): repeated keys and references that lead nowhere, of those that there are."""
    read = lambda name: read_table(spark, f"{root}/{name}", SERVED[name])
    there = {name for name in SERVED if exists(spark, f"{root}/{name}")}
    found = [duplicate_keys(read(t), k).agg(F.count("*").alias("n")).select(F.lit(f"{t}: repeated key").alias("check"), "n") for t, k in KEYS.items() if t in there]
    found += [dangling(read(t), c, read(p), k).agg(F.count("*").alias("n")).select(F.lit(f"{t}.{c}: no {p}").alias("check"), "n") for (t, c), (p, k) in PARENTS.items() if {t, p} <= there]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out.where("n > 0")


def bucket_by_page(df: DataFrame, table: str, buckets: int = 256, order: tuple[str, ...] = ("page_id", "revision_id")) -> None:
    """Save as a catalogue table, bucketed by page and sorted within: revisions, instances and
    histories of one number of buckets join by page without a shuffle, and one page is
    one bucket's files.  Joins on page and more columns need
    spark.sql.requireAllClusterKeysForCoPartition off to make use of it."""
    sort = [c for c in order if c in df.columns] or ["page_id"]
    # Rows of a bucket come together first: a file a bucket, not one a task and bucket.
    spread = df.repartition(buckets, "page_id")
    spread.write.bucketBy(buckets, "page_id").sortBy(sort[0], *sort[1:]).mode("overwrite").saveAsTable(table)
