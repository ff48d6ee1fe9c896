"""The report queries, as functions of tables and arguments.

What is not found gives no rows; bad arguments raise ValueError.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.udfs import parsed
from ..operators import lifecycle as L
from ..operators.derive import DEFAULT_DOMAIN
from ..sources.storage import cut

LIMIT, MOST = 100, 1000
#: Keys that a look-up sends to every task; with more it shuffles both sides.
FEW = 100_000


NAMES = ("revisions", "histories", "instances", "normalized", "documents", "web_resources", "ncwr", "wiki_templates", "template_data", "titles")


class Tables:
    """Logical tables by natural key, as attributes: DataFrames, or functions that make one
    when it is first asked for, so that a report opens the tables it reads and no others.
    titles: (domain, title, page_id), for addresses by title."""

    revisions: DataFrame
    histories: DataFrame
    instances: DataFrame
    normalized: DataFrame
    documents: DataFrame
    web_resources: DataFrame
    ncwr: DataFrame
    wiki_templates: DataFrame
    template_data: DataFrame
    titles: DataFrame

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]) -> None:
        if set(tables) != set(NAMES):
            raise ValueError(f"needed: {', '.join(NAMES)}")
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        found = self._tables[name]
        if callable(found):
            found = self._tables[name] = found()
        return found

    def replaced(self, **tables: DataFrame | Callable[[], DataFrame]) -> Tables:
        """The same with some tables in place of others."""
        return Tables(**self._tables | tables)


def paged(df: DataFrame, limit: int | None = LIMIT, offset: int | None = 0) -> DataFrame:
    """A page of an ordered result: at most MOST rows."""
    limit, offset = limit or LIMIT, offset or 0
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset are not negative")
    return df.offset(offset).limit(min(limit, MOST))


def met(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` whose columns ``on`` stand in ``keys``.  The keys are counted: FEW of them or less
    are broadcast, and what they do not meet never leaves its place."""
    keys = keys.select(*on).distinct()
    few = keys.limit(FEW + 1).count() <= FEW
    return rows.join(F.broadcast(keys) if few else keys, on, "left_semi")


def article(t: Tables, url: str) -> DataFrame:
    """A page by its address, with all its revisions; the latest is the last by time."""
    if not url:
        raise ValueError("a url is needed")
    page = t.web_resources.where((F.md5("url") == F.md5(F.lit(url))) & (F.col("url") == url) & F.col("page_id").isNotNull()).select("page_id", "url").limit(1)
    every = Window.partitionBy("page_id")
    latest = F.max(F.struct("revision_timestamp", "revision_id")).over(every)
    rows = page.join(t.revisions, "page_id").select(
        "page_id", "url", "revision_id", "revision_timestamp", "parent_revision_id",
        F.count("*").over(every).alias("revision_count"), latest["revision_id"].alias("latest_revision_id"),
    )
    return rows.orderBy("revision_timestamp", "revision_id")


def revision_counts(t: Tables, page_id: int) -> DataFrame:
    """A page's revisions with the number of citations in each, zero where there is none."""
    own = t.revisions.where(F.col("page_id") == page_id)
    cited = t.histories.where(F.col("page_id") == page_id).distinct().groupBy("revision_id").agg(F.count("*").alias("n"))
    return own.join(cited, "revision_id", "left").select(
        "revision_id", "revision_timestamp", "parent_revision_id", F.coalesce("n", F.lit(0)).alias("citation_count")
    )


def article_revisions(t: Tables, page_id: int, limit: int | None = LIMIT, offset: int | None = 0) -> DataFrame:
    """The page of ``revision_counts`` by time."""
    return paged(revision_counts(t, page_id).orderBy("revision_timestamp", "revision_id"), limit, offset)


def article_revisions_total(t: Tables, page_id: int) -> DataFrame:
    return t.revisions.where(F.col("page_id") == page_id).agg(F.count("*").alias("total"))


def of_page(t: Tables, page_id: int) -> Tables:
    """The tables with what concerns one page: the filter goes before everything else."""
    own = F.col("page_id") == page_id
    return t.replaced(revisions=lambda: t.revisions.where(own), histories=lambda: t.histories.where(own), instances=lambda: t.instances.where(own))


def lifecycle_all(t: Tables) -> DataFrame:
    """Every citation of every page at every revision."""
    return L.lifecycle(t.histories, t.revisions, t.instances)


def citations_at(
    t: Tables, page_id: int, revision_id: int | None = None, raw: bool = False, limit: int | None = None, offset: int | None = None, strict: bool = False
) -> DataFrame:
    """A page's citations at a revision, by default the one of the highest id, latest first.

    The revision need not be the page's own, unless ``strict``."""
    own = of_page(t, page_id)
    if strict and revision_id is not None and own.revisions.where(F.col("revision_id") == revision_id).isEmpty():
        raise ValueError(f"revision {revision_id} is not of page {page_id}")
    rows = L.lifecycle(own.histories, own.revisions, own.instances)
    if revision_id is None:
        rows = rows.join(own.revisions.agg(F.max("revision_id").alias("revision_id")), "revision_id")
    else:
        rows = rows.where(F.col("revision_id") == revision_id)
    rows = rows.withColumn("reference_type", C.type_label(F.col("reference_type")))
    life = ["first_seen_id", "first_seen_ts", "last_seen_id", "last_seen_ts", "appearance_count", "currently_visible"]
    if raw:
        out = rows.select("raw_sha1", "normalized_sha1", "reference_type", "reference_name", *life)
    else:
        texts = t.normalized.select("normalized_sha1", "reference_normalized")
        out = rows.join(texts, "normalized_sha1").select("raw_sha1", "normalized_sha1", "reference_normalized", "reference_type", "reference_name", *life, "removed_at_id", "removed_at_ts")
    out = out.orderBy(F.col("last_seen_ts").desc(), "raw_sha1")
    return paged(out, limit, offset) if limit is not None else out


def citation_links(t: Tables, sha1: str) -> DataFrame:
    held = t.ncwr.where(F.col("normalized_sha1") == sha1)
    return held.join(met(t.web_resources.select("url"), held, ["url"]).distinct(), "url").select("normalized_sha1", "url")


def citation_templates(t: Tables, sha1: str) -> DataFrame:
    return t.template_data.where(F.col("normalized_sha1") == sha1).select("normalized_sha1", "template_name", "offset_start", "parameter_key", "parameter_value")


def citation_template_maps(t: Tables, sha1: str) -> DataFrame:
    """Parameters of each template as a map, keys in order."""
    pairs = F.array_sort(F.collect_list(F.struct("parameter_key", "parameter_value")))
    return citation_templates(t, sha1).groupBy("normalized_sha1", "template_name", "offset_start").agg(F.map_from_entries(pairs).alias("parameters"))


def citation_detail(t: Tables, sha1: str) -> DataFrame:
    """One row: the text, the article it appears on, and links, templates and history as lists."""
    links = citation_links(t, sha1).groupBy("normalized_sha1").agg(F.sort_array(F.collect_set("url")).alias("links"))
    maps = citation_template_maps(t, sha1).groupBy("normalized_sha1").agg(F.collect_list(F.struct("template_name", "offset_start", "parameters")).alias("templates"))
    past = citation_history(t, sha1).select(F.lit(sha1).alias("normalized_sha1"), F.struct("revision_timestamp", "revision_id", "page_id").alias("h"))
    past = past.groupBy("normalized_sha1").agg(F.array_sort(F.collect_list("h")).alias("history"))
    out = t.normalized.where(F.col("normalized_sha1") == sha1)
    for part in (links, maps, past):
        out = out.join(part, "normalized_sha1", "left")
    return out


def citation_history(t: Tables, sha1: str, page_id: int | None = None) -> DataFrame:
    """Revisions a citation stands in, one row for each raw form of it there, by time."""
    forms = t.instances.where(F.col("normalized_sha1") == sha1)
    if page_id is not None:
        forms = forms.where(F.col("page_id") == page_id)
    rows = cut(met(t.histories, forms, ["page_id", "raw_sha1"]).distinct(), "history")
    stamped = met(t.revisions.select("revision_id", "revision_timestamp"), rows, ["revision_id"])
    return rows.join(stamped, "revision_id").select("revision_id", "revision_timestamp", "page_id").orderBy("revision_timestamp", "revision_id", "page_id")


def _template_rows(t: Tables, template: str, key: str, value: str | None, domain: str | None) -> DataFrame:
    if not key or value is None:
        raise ValueError("a parameter's key, and a value that may be empty, are needed")
    rows = t.template_data.where((F.col("template_name") == template) & (F.col("parameter_key") == key) & (F.col("parameter_value") == value))
    rows = rows if domain is None else rows.where(F.col("domain_label") == domain)
    return rows.select("normalized_sha1").join(t.normalized, "normalized_sha1").select("normalized_sha1", "reference_normalized", "appears_on_page_id")


def template_report(t: Tables, template: str, key: str, value: str | None, limit: int | None = LIMIT, offset: int | None = 0, domain: str | None = None) -> DataFrame:
    """Distinct citations whose template has a parameter of a value, by sha1."""
    return paged(_template_rows(t, template, key, value, domain).distinct().orderBy("normalized_sha1"), limit, offset)


def template_report_total(t: Tables, template: str, key: str, value: str | None, domain: str | None = None) -> DataFrame:
    return _template_rows(t, template, key, value, domain).distinct().agg(F.count("*").alias("total"))


def template_report_raw(t: Tables, template: str, key: str, value: str | None, domain: str | None = None) -> DataFrame:
    """The same, a row for each place of the template; an unknown template is named so."""
    unknown = t.wiki_templates.where(F.col("name") == template).isEmpty()
    return _template_rows(t, template, key, value, domain).withColumn("template", F.lit("Unknown" if unknown else template))


def web_resource(t: Tables, url: str) -> DataFrame:
    """An address: its host, its page if it is one's, and the citations that hold it."""
    own = t.web_resources.where((F.md5("url") == F.md5(F.lit(url))) & (F.col("url") == url))
    held = t.ncwr.where(F.col("url") == url).join(t.normalized.select("normalized_sha1", "appears_on_page_id"), "normalized_sha1")
    return own.select("url", F.col("domain_label").alias("domain"), "numeric_page_id").join(held, "url", "left").select("url", "domain", "numeric_page_id", "normalized_sha1", "appears_on_page_id")


def resolve_url(t: Tables, urls: DataFrame) -> DataFrame:
    """(url, resolved) for a column ``url``: an address by title becomes one by number, one by
    number stays, anything else is null."""
    parts = urls.select("url", C.parsed_wiki_url(F.col("url")).alias("p")).select("url", "p.*")
    pages = met(t.titles, parts, ["domain", "title"]).groupBy("domain", "title").agg(F.min("page_id").alias("page_id"))
    found = parts.join(pages, ["domain", "title"], "left")
    by_title = F.when(F.col("page_id").isNotNull() & (F.col("page_id") != -1), C.curid_url(F.col("domain"), F.col("page_id")))
    return found.select("url", F.when(F.col("is_curid"), F.col("url")).otherwise(by_title).alias("resolved"))


def explorer_article(t: Tables, url: str) -> DataFrame:
    """``article`` of an address by title or number, as it stands if it cannot be resolved."""
    one = t.revisions.sparkSession.createDataFrame([(url,)], "url string")
    resolved = resolve_url(t, one).first()["resolved"]
    return article(t, resolved or url)


def _article_urls(t: Tables, pages: DataFrame) -> DataFrame:
    """(page_id, url) of the pages given."""
    return met(t.web_resources.where("page_id is not null"), pages, ["page_id"]).groupBy("page_id").agg(F.min("url").alias("url"))


def _titles(t: Tables, pages: DataFrame) -> DataFrame:
    """(page_id, title) of the pages given."""
    return met(t.titles, pages, ["page_id"]).groupBy("page_id").agg(F.min("title").alias("title"))


def explorer_citations(t: Tables, page_id: int, revision_id: int | None = None) -> DataFrame:
    """``citations_at`` with the number of other articles that hold the citation as their
    own, none for a reference that is a name alone, and the address of the article."""
    rows = cut(citations_at(t, page_id, revision_id), "citations")
    homes = met(t.normalized, rows, ["normalized_sha1"]).select("normalized_sha1", F.col("appears_on_page_id").alias("home"))
    urls = _article_urls(t, homes.select(F.col("home").alias("page_id"))).withColumnRenamed("page_id", "home")
    rows = rows.join(homes.join(urls, "home", "left"), "normalized_sha1", "left")
    alone = C.is_name_only(F.col("reference_normalized"), F.col("reference_name"))
    other = F.col("home").isNotNull() & (F.col("home") != page_id) & ~alone
    rows = rows.withColumn("is_name_only", alone).withColumn("other_page_id", F.when(other, F.col("home"))).withColumn("other_url", F.when(other, F.col("url"))).drop("home", "url")
    return rows.orderBy(F.col("last_seen_ts").desc(), "raw_sha1")


def citation_report(t: Tables, sha1: str, page_id: int | None = None) -> DataFrame:
    """``citation_history`` with the article's title and address, joined by page."""
    rows = cut(citation_history(t, sha1, page_id), "report")
    out = rows.join(_titles(t, rows), "page_id", "left").join(_article_urls(t, rows), "page_id", "left")
    return out.select("revision_id", "revision_timestamp", "page_id", "title", "url").orderBy("revision_timestamp", "revision_id", "page_id")


def other_articles(t: Tables, sha1: str, exclude_page: int | None = None) -> DataFrame:
    """Pages that ever held a citation, without the one given, by title; none for a name alone
    that some instance bears."""
    text = t.normalized.where(F.col("normalized_sha1") == sha1)
    named = t.instances.where((F.col("normalized_sha1") == sha1) & (F.col("reference_name") != "")).select("normalized_sha1").limit(1)
    alone = text.where(C.is_name_only(F.col("reference_normalized"), F.lit("name"))).join(named, "normalized_sha1", "left_semi")
    forms = t.instances.where(F.col("normalized_sha1") == sha1).join(alone.select("normalized_sha1"), "normalized_sha1", "left_anti")
    if exclude_page is not None:
        forms = forms.where(F.col("page_id") != exclude_page)
    pages = cut(met(t.histories, forms, ["page_id", "raw_sha1"]).select("page_id").distinct(), "pages")
    out = pages.join(_titles(t, pages), "page_id", "left").join(_article_urls(t, pages), "page_id", "left")
    return out.select("page_id", "title", "url").orderBy(F.col("title").asc_nulls_last(), "page_id")


def page_references(revisions: DataFrame, titles: DataFrame, title: str, as_of: str | None = None, domain: str = DEFAULT_DOMAIN) -> DataFrame:
    """One row of a page as it stood at a time, now by default: title, as_of, page_id, revision_id,
    revision_timestamp, references (array of structs), and plain, the raw references with a
    blank line between.  ``revisions`` are those of bundles, with their text."""
    if not title:
        raise ValueError("a title is needed")
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if as_of is None else C.clean_timestamp(F.lit(as_of))
    page = titles.where((F.col("domain") == domain) & (F.col("title") == title)).select("page_id").distinct()
    own = revisions.join(page, "page_id", "left_semi").where(F.col("revision_timestamp") <= now)
    last = own.groupBy("page_id").agg(F.max(F.struct("revision_timestamp", "revision_id", "revision_text")).alias("r"))
    return last.select(
        F.lit(title).alias("title"), now.alias("as_of"), "page_id", "r.revision_id", "r.revision_timestamp", parsed(F.col("r.revision_text"), F.lit(domain)).alias("references")
    ).withColumn("plain", F.array_join(F.transform("references", lambda x: x["raw_reference"]), "\n\n"))
