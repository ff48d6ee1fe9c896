"""Staged tables from revisions: all are projections of one table of references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.udfs import parsed
from ..schemas import STAGED

DEFAULT_DOMAIN = "en.wikipedia.org"


def references(revisions: DataFrame, domain: str | Column = DEFAULT_DOMAIN) -> DataFrame:
    """A row for each reference that is not blank of each revision, with the domain."""
    site = F.lit(domain) if isinstance(domain, str) else domain
    rows = revisions.select("page_id", "revision_id", "parent_revision_id", C.clean_timestamp(F.col("revision_timestamp")).alias("revision_timestamp"), site.alias("domain"), "revision_text")
    refs = rows.withColumn("r", F.explode(parsed(F.col("revision_text"), F.col("domain")))).drop("revision_text")
    return refs.select(
        "*",
        C.sha1_text(F.col("r.raw_reference")).alias("raw_sha1"),
        C.sha1_text(F.col("r.normalized")).alias("normalized_sha1"),
    )


def derive(revisions: DataFrame, refs: DataFrame, domain: str = DEFAULT_DOMAIN) -> dict[str, DataFrame]:
    """The staged tables, by name.  ``refs`` is best a written table, as nine of them read it.

    A revision without a reference has a document and an address, but no row in revisions.
    """
    spark = revisions.sparkSession
    site = F.lit(domain)
    links = refs.select("normalized_sha1", F.explode("r.urls").alias("url")).where("url <> ''")
    hosts = links.select("url", C.netloc(F.col("url")).alias("host"))
    used = refs.select("domain", "normalized_sha1", F.explode(F.arrays_zip(F.col("r.templates").alias("t"), F.col("r.template_offsets").alias("o"))).alias("x"))
    used = used.where("x.t.template_name <> ''").select(
        F.col("domain").alias("domain_label"), C.template_name_norm(F.col("x.t.template_name")).alias("template_name"), "normalized_sha1", F.col("x.o").alias("offset_start"), F.col("x.t.parameters").alias("parameters")
    )
    given = used.select("*", F.explode("parameters").alias("p")).where("p.key <> ''")
    one = spark.range(1)
    tables = {
        "containers": one.select(site.alias("label")),
        "domains": one.select(site.alias("value"), site.alias("for_container_label")).union(
            hosts.where("host <> ''").select("host", F.lit(None).cast("string"))
        ),
        "documents": revisions.select(C.language_code(site).alias("language_code"), site.alias("has_container_label"), "page_id"),
        "web_resources": revisions.select(
            C.curid_url(site, F.col("page_id")).alias("url"), site.alias("domain_label"), F.col("page_id").alias("numeric_page_id"), F.col("namespace_id").alias("numeric_namespace_id"), "page_id"
        ).union(hosts.select("url", "host", *[F.lit(None).cast("int")] * 3)),
        "citation_instances": refs.select("page_id", "raw_sha1", "normalized_sha1", "r.reference_type", "r.reference_name"),
        "normalized_citations": refs.select("normalized_sha1", F.col("r.normalized").alias("reference_normalized"), F.col("page_id").alias("appears_on_page_id"), F.col("domain").alias("appears_on_domain")),
        "citation_histories": refs.select("page_id", "raw_sha1", "revision_id"),
        "revisions": refs.select("revision_id", "page_id", "parent_revision_id", "revision_timestamp"),
        "ncwr": links.select("normalized_sha1", "url"),
        "wiki_templates": used.select("domain_label", F.col("template_name").alias("name")),
        "template_data": given.select("domain_label", "template_name", "normalized_sha1", "offset_start", F.col("p.key").alias("parameter_key"), F.col("p.value").alias("parameter_value")),
    }
    return {name: conform(tables[name], name) for name in STAGED}


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns in order and type; a missing one is null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in STAGED[table].fields])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) of each staged table, repeats counted."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out
