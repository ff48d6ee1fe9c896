"""The build: bundles to staged tables to deduplicated tables to served tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import upsert as U
from ..operators.dedup import dedup_table
from ..operators.derive import DEFAULT_DOMAIN, derive, references
from ..operators.keys import assign_ids, bounded, resolve
from ..schemas import DDL, SERVED, STAGED
from ..sources.bundle import read_bundles
from ..sources.staging import read_staged, staged_or_empty, write_deduped, write_staged
from ..sources.storage import append_table, cut, delete, empty, exists, mark, read_table, replace_table

#: Served tables in the order of their references.
LOAD_ORDER = (
    "containers", "domains", "documents", "web_resources", "normalized_citations", "citation_instances", "revisions",
    "citation_history", "normalized_citation_web_resources", "wiki_templates", "template_data",
)


def stage(spark: SparkSession, bundles: str | DataFrame, root: str, domain: str = DEFAULT_DOMAIN, stem: str = "run") -> None:
    """Parse bundles (a folder, or REVISION rows) and write the staged tables of one run.
    References are extracted once and written, as nine tables come from them."""
    revisions = read_bundles(spark, bundles) if isinstance(bundles, str) else bundles
    refs = cut(references(revisions, domain), "references")
    write_staged(derive(revisions, refs, domain), root, stem)


def dedup(spark: SparkSession, root: str, target: str, tables: list[str] | None = None, resume: bool = False) -> list[str]:
    """Deduplicate staged tables, all or some; those that are not there are passed over.  Each table
    that is done is marked, whether it was there or not; to ``resume`` passes over marked ones."""
    done = []
    for name in tables or list(STAGED):
        marker = f"{target}/_done/{name}"
        if resume and exists(spark, marker):
            continue
        delete(spark, marker)
        rows = read_staged(spark, root, name)
        if rows is not None:
            write_deduped(dedup_table(rows, name), target, name)
            done.append(name)
        mark(spark, marker)
    return done


class Loader:
    """Loads deduplicated tables into served ones.

    Served tables are Parquet folders under ``root``; every load is a merge by natural
    key, so that a second load of the same rows changes nothing, and ids once given stay.
    """

    def __init__(self, spark: SparkSession, source: str, root: str) -> None:
        self.spark, self.source, self.root = spark, source, root

    def staged(self, name: str) -> DataFrame:
        path = f"{self.source}/{name}"
        return self.spark.read.schema(STAGED[name]).parquet(path) if exists(self.spark, path) else empty(self.spark, STAGED[name])

    def served(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.root}/{name}", SERVED[name])

    def load(self, tables: list[str] | None = None) -> None:
        """All tables, or some, in the order of their references; the others are read as
        they are served, so a part of the tables finds its parents."""
        wanted = set(tables or LOAD_ORDER)
        if unknown := wanted - set(LOAD_ORDER):
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        for name in LOAD_ORDER:
            if name in wanted:
                getattr(self, f"_{name}")()

    def _merge(self, name: str, new: DataFrame, key: list[str], policy: str = U.REPLACE, with_ids: bool = True) -> None:
        """New keys are appended.  The table is written anew only where a row that it holds changes,
        and not touched where none does and no key is new."""
        old, path = self.served(name), f"{self.root}/{name}"
        kinds = {f.name: f.dataType for f in SERVED[name].fields if not (with_ids and f.name == "id")}
        typed = new.select(*[F.col(c).cast(k) if c in new.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()])
        added, changed = U.changes(old.select(*kinds), typed, key, policy)
        added, changed = cut(added, f"{name}-added"), cut(changed, f"{name}-changed")
        if with_ids:
            highest = old.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
            added = assign_ids(added, key, highest).withColumn("id", F.col("id").cast(SERVED[name]["id"].dataType))
        added = added.select(*SERVED[name].names)
        if not changed.isEmpty():
            rest = [c for c in kinds if c not in key]
            now = changed.withColumn("_new", F.lit(True)).withColumnsRenamed({c: f"_{c}" for c in rest})
            kept = old.join(bounded(now), key, "left").select(*[F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in rest else F.col(c) for c in SERVED[name].names])
            replace_table(kept.unionByName(added), path)
        elif not exists(self.spark, path) or not added.isEmpty():
            append_table(added, path)

    def _containers(self) -> None:
        self._merge("containers", self.staged("containers"), ["label"], U.COALESCE)

    def _domains(self) -> None:
        rows = resolve(self.staged("domains"), self.served("containers"), {"for_container_label": "label"}, "for_container", keep_missing=True)
        self._merge("domains", rows.select("value", "for_container"), ["value"])

    def _documents(self) -> None:
        rows = resolve(self.staged("documents"), self.served("containers"), {"has_container_label": "label"}, "has_container", keep_missing=True)
        self._merge("documents", rows.select("language_code", "has_container", "page_id").na.fill({"has_container": -1}), ["has_container", "page_id"], U.COALESCE)

    def _web_resources(self) -> None:
        rows = resolve(self.staged("web_resources"), self.served("domains"), {"domain_label": "value"}, "domain_id", keep_missing=True)
        pages = self.served("documents").groupBy("page_id").agg(F.min("id").alias("id"))
        rows = resolve(rows, pages, {"page_id": "page_id"}, "instance_of_document", keep_missing=True)
        rows = rows.select("url", C.url_hash(F.col("url")).alias("url_hash"), "domain_id", "numeric_page_id", "numeric_namespace_id", "instance_of_document")
        self._merge("web_resources", rows, ["url_hash"], U.COALESCE)

    def _normalized_citations(self) -> None:
        """A citation whose page has no document is passed over."""
        pages = self.served("documents").groupBy("page_id").agg(F.min("id").alias("id"))
        rows = resolve(self.staged("normalized_citations"), pages, {"appears_on_page_id": "page_id"}, "appears_on_article", keep_missing=False)
        self._merge("normalized_citations", rows.select("normalized_sha1", "reference_normalized", "appears_on_article"), ["normalized_sha1"])

    def _citation_instances(self) -> None:
        rows = resolve(self.staged("citation_instances"), self.served("normalized_citations"), {"normalized_sha1": "normalized_sha1"}, "normalized_id", keep_missing=False)
        self._merge("citation_instances", rows.drop("normalized_sha1"), ["page_id", "raw_sha1"])

    def _revisions(self) -> None:
        self._merge("revisions", self.staged("revisions"), ["revision_id"], with_ids=False)

    def _citation_history(self) -> None:
        rows = resolve(self.staged("citation_histories"), self.served("citation_instances"), {"page_id": "page_id", "raw_sha1": "raw_sha1"}, "citation_instance_id", keep_missing=False)
        self._merge("citation_history", rows.drop("raw_sha1"), ["page_id", "citation_instance_id", "revision_id"], U.IGNORE, with_ids=False)

    def _normalized_citation_web_resources(self) -> None:
        rows = resolve(self.staged("ncwr"), self.served("normalized_citations"), {"normalized_sha1": "normalized_sha1"}, "normalized_id", keep_missing=False)
        rows = resolve(rows, self.served("web_resources"), {"url": "url"}, "web_resource_id", keep_missing=False)
        self._merge("normalized_citation_web_resources", rows.select("normalized_id", "web_resource_id"), ["normalized_id", "web_resource_id"], U.IGNORE, with_ids=False)

    def _wiki_templates(self) -> None:
        rows = resolve(self.staged("wiki_templates"), self.served("domains"), {"domain_label": "value"}, "domain_id", keep_missing=False)
        self._merge("wiki_templates", rows.select("domain_id", C.template_name_norm(F.col("name")).alias("name")).distinct(), ["domain_id", "name"], U.COALESCE)

    def _template_data(self) -> None:
        rows = resolve(self.staged("template_data"), self.served("domains"), {"domain_label": "value"}, "domain_id", keep_missing=False)
        rows = resolve(rows, self.served("wiki_templates"), {"domain_id": "domain_id", "template_name": "name"}, "wiki_template_id", keep_missing=False)
        rows = resolve(rows, self.served("normalized_citations"), {"normalized_sha1": "normalized_sha1"}, "normalized_id", keep_missing=False)
        rows = rows.select("wiki_template_id", "normalized_id", "offset_start", "parameter_key", C.url_hash(F.col("parameter_key")).alias("parameter_key_md5"), "parameter_value")
        self._merge("template_data", rows, ["wiki_template_id", "normalized_id", "offset_start", "parameter_key_md5"], with_ids=False)


def missed_histories(loader: Loader) -> int:
    """Staged histories whose instance is not served."""
    ids = loader.served("citation_instances").select("page_id", "raw_sha1")
    return loader.staged("citation_histories").join(ids, ["page_id", "raw_sha1"], "left_anti").count()


def build(spark: SparkSession, bundles: str, work: str, domain: str = DEFAULT_DOMAIN, stem: str = "run", resume: bool = False) -> Loader:
    """All of it; a step that fails leaves the served tables as they were.  To ``resume`` a run
    that died passes over what it had done: the staging, the tables deduplicated and the
    tables loaded."""
    staged, marks = f"{work}/_done/staged-{stem}", f"{work}/_done/loaded-{stem}"
    if not resume:
        delete(spark, staged)
        delete(spark, marks)
        delete(spark, f"{work}/deduped/_done")
    if not exists(spark, staged):
        stage(spark, bundles, f"{work}/staged", domain, stem)
        mark(spark, staged)
    dedup(spark, f"{work}/staged", f"{work}/deduped", resume=True)
    loader = Loader(spark, f"{work}/deduped", f"{work}/served")
    for name in LOAD_ORDER:
        if not exists(spark, f"{marks}/{name}"):
            loader.load([name])
            mark(spark, f"{marks}/{name}")
    return loader


def staged_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every staged table, empty where it was not written."""
    return {name: staged_or_empty(spark, root, name) for name in DDL}
