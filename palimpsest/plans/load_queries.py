"""Registered queries of two loads, one after the other, each table by its natural keys.

The second load brings new keys, changed rows and rows that are gone from the first; the SQL
says what each table's policy leaves.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.derive import conform
from ..operators.keys import bounded
from ..schemas import STAGED
from ..sources.storage import delete_at_exit, read_table, scratch
from ..streaming import ingest
from . import adapter
from .build import Loader
from .registry import registered
from .wikitext_queries import REVISED, bundle_lines, revised

#: Revisions of a bundle that ``ingest_bundles`` writes, in each of its runs, about.
ROWS_A_BUNDLE = 200_000
_LOADED: dict[tuple[str, str], Loader] = {}
#: Pages of the first load, and of either.
_A, _ANY = "page_id % 3 <> 0", "(page_id % 3 <> 0 OR page_id % 2 = 0)"

_SQL = f"""
WITH c AS (SELECT c_custkey::INT AS page_id, r_name AS label FROM customer JOIN region ON r_regionkey = c_custkey % 5),
d AS (
  SELECT page_id, label, CASE WHEN page_id % 2 = 0 AND page_id % 4 <> 0 THEN 'bb' WHEN {_A} THEN 'aa' END AS language_code FROM c WHERE {_ANY}
), p AS (
  SELECT p_partkey AS k, (p_partkey % 150)::INT AS pa, ((p_partkey + 1) % 150)::INT AS pb, '{{{{P|' || p_partkey || '}}}}' AS text, sha1('<ref>p' || p_partkey || '</ref>') AS raw_sha1 FROM part
), n AS (
  SELECT *, sha1(text) AS normalized_sha1, k % 3 <> 0 AND pa IN (SELECT page_id FROM c WHERE {_A}) AS a, k % 2 = 0 AND pb IN (SELECT page_id FROM d) AS b FROM p
), i AS (SELECT *, a AS ia, k % 2 = 0 AND (a OR b) AS ib FROM n),
da AS (SELECT 'n' || n_nationkey AS dom FROM nation WHERE n_nationkey % 3 <> 0), dany AS (SELECT 'n' || n_nationkey AS dom FROM nation WHERE n_nationkey % 3 <> 0 OR n_nationkey % 2 = 0),
w AS (SELECT *, 'n' || k % 25 AS doma, 'n' || (k + 1) % 25 AS domb, 'https://w.example/' || k AS url FROM i),
ta AS (SELECT DISTINCT doma AS dom, 'Cite ' || k % 10 AS name FROM w WHERE k % 3 <> 0 AND doma IN (SELECT dom FROM da)),
t AS (SELECT * FROM ta UNION SELECT DISTINCT domb, 'Cite ' || k % 10 FROM w WHERE k % 2 = 0 AND domb IN (SELECT dom FROM dany))
"""


def _url() -> Column:
    return F.concat(F.lit("https://w.example/"), F.col("p_partkey").cast("string")).alias("url")


def _domain(second: bool) -> Column:
    return F.concat(F.lit("n"), ((F.col("p_partkey") + int(second)) % 25).cast("string")).alias("domain_label")


def _staged(spark: SparkSession, sf: str, second: bool) -> dict[str, DataFrame]:
    read = lambda name: adapter.read(spark, sf, name)
    own = lambda k: F.col(k) % 2 == 0 if second else F.col(k) % 3 != 0
    either = lambda new, old: new if second else old
    region = read("region")
    nation = read("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    customer = read("customer").where(own("c_custkey")).join(region, F.col("r_regionkey") == F.col("c_custkey") % 5)
    key = F.col("p_partkey")
    text = F.concat(F.lit("{{P|"), key.cast("string"), F.lit("}}"))
    part = read("part").where(own("p_partkey")).select(
        key, (key % 150).cast("int").alias("pa"), ((key + 1) % 150).cast("int").alias("pb"), text.alias("text"), C.sha1_text(text).alias("normalized_sha1"),
        C.sha1_text(F.concat(F.lit("<ref>p"), key.cast("string"), F.lit("</ref>"))).alias("raw_sha1"),
    )
    orders = adapter.raw_revisions(spark, sf).where(own("revision_id"))
    label = F.when(F.col("n_nationkey") % 5 != 0, F.col("r_name")) if second else F.col("r_name")
    tables = {
        "containers": region.select(F.col("r_name").alias("label")),
        "domains": nation.where(own("n_nationkey")).select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("value"), label.alias("for_container_label")),
        "documents": customer.select(
            either(F.when(F.col("c_custkey") % 4 != 0, "bb"), F.lit("aa")).alias("language_code"), F.col("r_name").alias("has_container_label"), F.col("c_custkey").cast("int").alias("page_id")
        ),
        "normalized_citations": part.select("normalized_sha1", either(F.concat(F.lit("new "), "text"), F.col("text")).alias("reference_normalized"), F.col(either("pb", "pa")).alias("appears_on_page_id")),
        "citation_instances": part.select(
            F.col("pa").alias("page_id"), "raw_sha1", "normalized_sha1", either(F.lit(3), key % 3).alias("reference_type"), either(F.lit(None), F.concat(F.lit("n"), key.cast("string"))).alias("reference_name")
        ),
        "revisions": orders.select(
            "revision_id", "page_id", either(F.lit(None), F.col("parent_revision_id")).alias("parent_revision_id"), either(F.lit("2001-01-01 00:00:00"), F.col("revision_timestamp")).alias("revision_timestamp")
        ),
        "web_resources": part.select(
            _url(), _domain(second), *[either(F.lit(None), F.col("pa") if c != "numeric_namespace_id" else F.lit(0)).alias(c) for c in ("numeric_page_id", "numeric_namespace_id", "page_id")]
        ),
        "ncwr": part.select("normalized_sha1", _url()),
        "wiki_templates": part.select(_domain(second), F.concat(F.lit(either(" cite ", "cite_")), (key % 10).cast("string"), F.lit(" ")).alias("name")),
        "template_data": part.select(
            _domain(False), F.concat(F.lit("Cite "), (key % 10).cast("string")).alias("template_name"), "normalized_sha1", F.lit(0).alias("offset_start"), F.lit("p").alias("parameter_key"),
            F.concat(F.lit(either("new ", "old ")), key.cast("string")).alias("parameter_value"),
        ),
        "citation_histories": part.select(F.col("pa").alias("page_id"), "raw_sha1", (key + either(1_000_000, 0)).alias("revision_id")),
    }
    return {name: conform(df, name) for name, df in tables.items()}


def loaded(spark: SparkSession, sf: str) -> Loader:
    """Both loads, once an application and folder."""
    known = (spark.sparkContext.applicationId, sf)
    if known not in _LOADED:
        work = f"{scratch(spark)}/loads-{uuid.uuid4().hex}"
        delete_at_exit(spark, work)
        for second in (False, True):
            for name, df in _staged(spark, sf, second).items():
                df.write.parquet(f"{work}/{second}/{name}")
            loader = Loader(spark, f"{work}/{second}", f"{work}/served")
            loader.load()
        _LOADED[known] = loader
    return _LOADED[known]


def _load_query(sql: str, name: str) -> Callable:
    return registered(name, _SQL + sql, logical=False)


@_load_query("SELECT r_name AS label, count(*) AS n FROM region GROUP BY ALL", "load_containers")
def load_containers(spark: SparkSession, d: str) -> DataFrame:
    """A second load of the same keys leaves one row of each."""
    return loaded(spark, d).served("containers").groupBy("label").agg(F.count("*").alias("n"))


@_load_query("""
SELECT 'n' || n_nationkey AS value, CASE WHEN n_nationkey % 2 <> 0 OR n_nationkey % 5 <> 0 THEN r_name END AS label
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 3 <> 0 OR n_nationkey % 2 = 0""", "load_domains")  # fmt: skip
def load_domains(spark: SparkSession, d: str) -> DataFrame:
    """New rows take the place of old ones, nulls too."""
    t = loaded(spark, d)
    labels = t.served("containers").select(F.col("id").alias("for_container"), "label")
    return t.served("domains").join(labels, "for_container", "left").select("value", "label")


@_load_query("SELECT page_id, label, language_code FROM d", "load_documents")
def load_documents(spark: SparkSession, d: str) -> DataFrame:
    """New values take the place of old ones where they are not null."""
    t = loaded(spark, d)
    labels = t.served("containers").select(F.col("id").alias("has_container"), "label")
    return t.served("documents").join(bounded(labels), "has_container").select("page_id", "label", "language_code")


@_load_query("SELECT normalized_sha1, CASE WHEN b THEN 'new ' || text ELSE text END AS reference_normalized, CASE WHEN b THEN pb ELSE pa END AS page_id FROM n WHERE a OR b", "load_normalized_citations")
def load_normalized_citations(spark: SparkSession, d: str) -> DataFrame:
    """The last load's text and page; a citation of a page without a document is passed over."""
    t = loaded(spark, d)
    pages = t.served("documents").select(F.col("id").alias("appears_on_article"), "page_id")
    return t.served("normalized_citations").join(bounded(pages), "appears_on_article").select("normalized_sha1", "reference_normalized", "page_id")


@_load_query("""
SELECT pa AS page_id, raw_sha1, normalized_sha1, CASE WHEN ib THEN 3 ELSE k % 3 END::SMALLINT AS reference_type, CASE WHEN NOT ib THEN 'n' || k END AS reference_name
FROM i WHERE ia OR ib""", "load_citation_instances")  # fmt: skip
def load_citation_instances(spark: SparkSession, d: str) -> DataFrame:
    """By page and raw form; those of a citation that is not served are passed over."""
    t = loaded(spark, d)
    texts = t.served("normalized_citations").select(F.col("id").alias("normalized_id"), "normalized_sha1")
    return t.served("citation_instances").join(bounded(texts), "normalized_id").select("page_id", "raw_sha1", "normalized_sha1", "reference_type", "reference_name")


@_load_query("""
SELECT o_orderkey AS revision_id, o_custkey::INT AS page_id,
       CASE WHEN o_orderkey % 2 <> 0 THEN lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) END AS parent_revision_id,
       CASE WHEN o_orderkey % 2 = 0 THEN '2001-01-01 00:00:00' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS revision_timestamp
FROM orders QUALIFY o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0""", "load_revisions")  # fmt: skip
def load_revisions(spark: SparkSession, d: str) -> DataFrame:
    return loaded(spark, d).served("revisions").select("revision_id", "page_id", "parent_revision_id", "revision_timestamp")


@_load_query("""
SELECT pa AS page_id, raw_sha1, k AS revision_id FROM i WHERE ia
UNION ALL SELECT pa, raw_sha1, k + 1000000 FROM i WHERE k % 2 = 0 AND (ia OR ib)""", "load_citation_history")  # fmt: skip
def load_citation_history(spark: SparkSession, d: str) -> DataFrame:
    """Rows are added and never changed."""
    t = loaded(spark, d)
    forms = t.served("citation_instances").select(F.col("id").alias("citation_instance_id"), "raw_sha1")
    return t.served("citation_history").join(bounded(forms), "citation_instance_id").select("page_id", "raw_sha1", "revision_id")


def _domains(t: Loader) -> DataFrame:
    return t.served("domains").select(F.col("id").alias("domain_id"), F.col("value").alias("domain"))


@_load_query("""
SELECT url, coalesce(CASE WHEN k % 2 = 0 AND domb IN (SELECT dom FROM dany) THEN domb END, CASE WHEN k % 3 <> 0 AND doma IN (SELECT dom FROM da) THEN doma END) AS domain,
       CASE WHEN k % 3 <> 0 THEN pa END AS numeric_page_id, CASE WHEN k % 3 <> 0 THEN 0 END AS numeric_namespace_id,
       CASE WHEN k % 3 <> 0 AND pa IN (SELECT page_id FROM c WHERE page_id % 3 <> 0) THEN pa END AS page_id
FROM w WHERE k % 3 <> 0 OR k % 2 = 0""", "load_web_resources")  # fmt: skip
def load_web_resources(spark: SparkSession, d: str) -> DataFrame:
    """By the hash of the address; what is not known leaves what was."""
    t = loaded(spark, d)
    pages = t.served("documents").select(F.col("id").alias("instance_of_document"), "page_id")
    rows = t.served("web_resources").where(F.col("url_hash") == C.url_hash(F.col("url"))).join(_domains(t), "domain_id", "left").join(bounded(pages), "instance_of_document", "left")
    return rows.select("url", "domain", "numeric_page_id", "numeric_namespace_id", "page_id")


@_load_query("SELECT normalized_sha1, url FROM w WHERE k % 3 <> 0 AND a OR k % 2 = 0 AND (a OR b)", "load_citation_web_resources")
def load_citation_web_resources(spark: SparkSession, d: str) -> DataFrame:
    t = loaded(spark, d)
    texts = t.served("normalized_citations").select(F.col("id").alias("normalized_id"), "normalized_sha1")
    urls = t.served("web_resources").select(F.col("id").alias("web_resource_id"), "url")
    return t.served("normalized_citation_web_resources").join(bounded(texts), "normalized_id").join(bounded(urls), "web_resource_id").select("normalized_sha1", "url")


@_load_query("SELECT dom AS domain, name FROM t", "load_wiki_templates")
def load_wiki_templates(spark: SparkSession, d: str) -> DataFrame:
    """Names in their normal form, each once a domain; those of a domain that is not served are passed over."""
    t = loaded(spark, d)
    return t.served("wiki_templates").join(_domains(t), "domain_id").select("domain", "name")


@_load_query("""
SELECT doma AS domain, 'Cite ' || k % 10 AS name, normalized_sha1, 0 AS offset_start, 'p' AS parameter_key, md5('p') AS parameter_key_md5,
       CASE WHEN vb THEN 'new ' || k ELSE 'old ' || k END AS parameter_value
FROM (SELECT *, k % 3 <> 0 AND a AND (doma, 'Cite ' || k % 10) IN (SELECT (dom, name) FROM ta) AS va,
             k % 2 = 0 AND (a OR b) AND (doma, 'Cite ' || k % 10) IN (SELECT (dom, name) FROM t) AS vb FROM w) WHERE va OR vb""", "load_template_data")  # fmt: skip
def load_template_data(spark: SparkSession, d: str) -> DataFrame:
    t = loaded(spark, d)
    texts = t.served("normalized_citations").select(F.col("id").alias("normalized_id"), "normalized_sha1")
    names = t.served("wiki_templates").select(F.col("id").alias("wiki_template_id"), "domain_id", "name").join(_domains(t), "domain_id")
    rows = t.served("template_data").join(bounded(texts), "normalized_id").join(bounded(names), "wiki_template_id")
    return rows.select("domain", "name", "normalized_sha1", "offset_start", "parameter_key", "parameter_key_md5", "parameter_value")


@registered("ingest_bundles", REVISED + """
SELECT page_id, count(DISTINCT raw_sha1) AS instances, count(*) AS histories, count(DISTINCT revision_id) AS revisions
FROM (SELECT DISTINCT page_id, sha1(raw) AS raw_sha1, revision_id FROM y_ref) GROUP BY page_id""")  # fmt: skip
def ingest_bundles(spark: SparkSession, d: str) -> DataFrame:
    """Bundles taken in by a stream as they come, in two runs: what is served then."""
    work = f"{scratch(spark)}/ingest-{uuid.uuid4().hex}"
    delete_at_exit(spark, work)
    rows = revised(spark, d)
    # A bundle is one task's; a batch of the stream takes up to 64 of them.
    bundles = min(64, max(4, -(-adapter.read(spark, d, "orders").count() // ROWS_A_BUNDLE)))
    for part in (0, 1):
        lines = bundle_lines(rows.where(F.col("page_id") % 2 == part))
        lines.repartition(bundles).write.mode("append").option("compression", "gzip").text(f"{work}/in")
        ingest.ingest_bundles(spark, f"{work}/in", work, suffix=".txt.gz", load=True)
    t = Loader(spark, "", f"{work}/served")
    instances = t.served("citation_instances").groupBy("page_id").agg(F.count("*").alias("instances"))
    histories = t.served("citation_history").groupBy("page_id").agg(F.count("*").alias("histories"))
    revisions = t.served("revisions").groupBy("page_id").agg(F.count("*").alias("revisions"))
    return instances.join(histories, "page_id").join(revisions, "page_id").select("page_id", "instances", "histories", "revisions")


@registered("ingest_rows", """
SELECT n_name AS value, CASE WHEN n_nationkey % 2 = 0 AND n_nationkey % 4 <> 0 THEN 'new ' || n_nationkey WHEN n_nationkey % 3 <> 0 THEN 'old ' || n_nationkey END AS for_container_label
FROM nation WHERE n_nationkey % 3 <> 0 OR n_nationkey % 2 = 0""", logical=False)  # fmt: skip
def ingest_rows(spark: SparkSession, d: str) -> DataFrame:
    """Files of staged rows merged by a stream into a keyed table, in two runs; nulls leave what was there."""
    work = f"{scratch(spark)}/rows-{uuid.uuid4().hex}"
    delete_at_exit(spark, work)
    key = F.col("n_nationkey")
    label = lambda word: F.concat(F.lit(word), key.cast("string")).alias("for_container_label")
    nation = adapter.read(spark, d, "nation")
    for rows in (nation.where(key % 3 != 0).select(F.col("n_name").alias("value"), label("old ")), nation.where(key % 2 == 0).select(F.col("n_name").alias("value"), F.when(key % 4 != 0, label("new ")).alias("for_container_label"))):
        rows.coalesce(1).write.mode("append").parquet(f"{work}/in")
        ingest.ingest_rows(spark, f"{work}/in", "domains", f"{work}/out", f"{work}/checkpoint", ["value"], "coalesce")
    return read_table(spark, f"{work}/out", STAGED["domains"])
