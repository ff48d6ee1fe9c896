"""Registered queries of the wikitext rules, the derived tables and the sources, over texts made
of the driver's columns.

A text is a template: what stands between « and » is a column's value, in Spark and in SQL alike,
so that the SQL states what a rule must give without reading wikitext.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.config import wiki_config
from ..functions.udfs import normalize, parsed, spread
from ..operators import derive as D
from ..sources import bundle, staging
from ..sources.storage import cut, delete_at_exit, scratch
from . import adapter, reports
from .registry import registered

_COLUMN = re.compile(r"«(\w+)»")


def spark_text(template: str) -> Column:
    parts = _COLUMN.split(template)
    return F.concat(*[F.col(p).cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def sql_text(template: str) -> str:
    quoted = [f"{p}::VARCHAR" if i % 2 else "'" + p.replace("'", "''") + "'" for i, p in enumerate(_COLUMN.split(template))]
    return "(" + " || ".join(quoted) + ")"


# -- normal form ------------------------------------------------------------------------------

#: Rule: a text, and its normal form.
NORMAL = {
    "normalize_trimmed": ("\n  {{a|«p_name»}} \t\n", "{{A|«p_name»}}"),
    "normalize_template_name": ("{{ cite_«p_brand» | «p_name» }}", "{{Cite «p_brand»|«p_name»}}"),
    "normalize_positional_first": ("{{q| k = 1 | «p_name» |\n«p_brand» }}", "{{Q|«p_name»|«p_brand»|k=1}}"),
    "normalize_named_order": ("{{q|url=«p_size»|url-access=«p_brand»|url-status=x|a=«p_name»}}", "{{Q|a=«p_name»|url-access=«p_brand»|url-status=x|url=«p_size»}}"),
    "normalize_spaces": ("{{q| v = one\n  «p_name»\t three }}", "{{Q|v=one «p_name» three}}"),
    "normalize_nested": ("{{q|a={{ inner_x | «p_name» }}|[https://e.org {{ lang | «p_brand» }}]}}", "{{Q|[https://e.org {{Lang|«p_brand»}}]|a={{Inner x|«p_name»}}}}"),
    "normalize_numeric_key": ("{{q|«p_name»|b=«p_size»|2=«p_brand»}}", "{{Q|«p_name»|2=«p_brand»|b=«p_size»}}"),
    "normalize_wikilink": ("see [[A_«p_size»_c]] and [[x_y|«p_name»_m]]", "see [[A «p_size» c]] and [[x y|«p_name»_m]]"),
    "normalize_ref_attributes": (
        "<ref name=n«p_size»/><ref name = '«p_name»' group=g>«p_brand»</ref><ref name=e«p_size»></ref>",
        '<ref name="n«p_size»" /><ref name="«p_name»" group="g">«p_brand»</ref><ref name="e«p_size»"></ref>',
    ),
    "normalize_ref_body": ("<ref>\n «p_name»\n«p_brand» \n</ref>", "<ref>«p_name»\n«p_brand»</ref>"),
    "normalize_nowiki": ("<ref>{{a | «p_name»}}<nowiki>{{a | «p_brand»}}</nowiki></ref>", "<ref>{{A|«p_name»}}<nowiki>{{a | «p_brand»}}</nowiki></ref>"),
    "normalize_list_markers": ("**«p_name»\n#   «p_brand»\n*item «p_size»", "** «p_name»\n# «p_brand»\n* item «p_size»"),
    "normalize_external_link": ("{{q|url = [http://e.org/«p_partkey» L=«p_name»]}}", "{{Q|url=[http://e.org/«p_partkey» L=«p_name»]}}"),
    "normalize_magic_word": ("{{CURRENTYEAR}} «p_name» {{PAGENAME}}", "{{CURRENTYEAR}} «p_name» {{PAGENAME}}"),
}


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return spread(adapter.read(spark, d, "part"), "p_partkey")


def _normal_query(source: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: _parts(spark, d).select("p_partkey", normalize(spark_text(source)).alias("normal"))


for _name, (_source, _expected) in NORMAL.items():
    registered(_name, f"SELECT p_partkey, {sql_text(_expected)} AS normal FROM part", logical=False)(_normal_query(_source))


# -- extraction -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Ref:
    """A stretch of a text that is a reference."""

    raw: str
    kind: int
    name: str | None = None


#: Rule: a text in stretches; those that are references must be found, and no others.
EXTRACT: dict[str, list[str | Ref]] = {
    "extract_ref": ["Start ", Ref("<ref name=n«p_size»>«p_name», http://e.org/«p_partkey»</ref>", 1, "n«p_size»"), " énd ", Ref("<ref>«p_brand»</ref>", 1)],
    "extract_ref_self_closing": ["A", Ref("<ref name=s«p_partkey» />", 1, "s«p_partkey»"), " b ", Ref("<ref name='«p_name»' />", 1, "«p_name»")],
    "extract_short_footnote": ["Text ", Ref("{{Sfn|«p_name»|«p_size»}}", 1), " and {{Other|«p_brand»}}."],
    "extract_section_items": [
        "Intro.\n== References ==\n", Ref("* [http://e.org/«p_partkey» «p_name»]", 2), "\n* «p_brand» without a link\n", Ref("* see [[«p_name»]]", 2),
        "\n=== Books ===\n", Ref("* {{cite book|title=«p_name»}}", 2), "\n",
    ],
    "extract_url_items": ["== References ==\n", Ref("* [[«p_brand»]]", 2), "\n== History ==\n", Ref("* «p_name» http://e.org/«p_partkey»", 0), "\n"],
    "extract_plain_items": ["== History ==\n* «p_name» alone\n# «p_brand» [[x]]\n", Ref("* http://e.org/«p_size»", 0), "\n"],
    "extract_prose_urls": [
        "See ", Ref("http://e.org/«p_partkey»/a?b=«p_size»", 0), ". Not ", Ref("<ref>http://f.org/«p_partkey»</ref>", 1), " twice, but ",
        Ref("[http://g.org/«p_size» «p_name»]", 0), ".",
    ],
    "extract_commented": ["<!-- <ref>«p_name»</ref> http://c.org/«p_size» --> a ", Ref("<ref>«p_brand»</ref>", 1), " <nowiki><ref>x</ref></nowiki>"],
    "extract_citation_templates": [
        Ref("{{CITE web|title=«p_name»}}", 0), " {{Infobox|«p_brand»|http://i.org/«p_size»}} ", Ref("{{Citation|«p_size»}}", 0), " {{Cited|«p_name»}}",
    ],
    "extract_types": [
        "A", Ref("<ref>«p_name»</ref>", 1), "{{note|«p_brand»}}", Ref("{{Harvnb|«p_brand»|«p_size»}}", 1), " ", Ref("http://e.org/«p_size»", 0),
        "\n==Further reading==\n", Ref("# «p_brand» [[«p_name»]]", 2), "\n",
    ],
}


def _extract_query(stretches: list[str | Ref]) -> Callable[[SparkSession, str], DataFrame]:
    text = "".join(s if isinstance(s, str) else s.raw for s in stretches)

    def query(spark: SparkSession, d: str) -> DataFrame:
        rows = _parts(spark, d).select("p_partkey", F.explode(parsed(spark_text(text), F.lit("en.wikipedia.org"))).alias("r"))
        return rows.select("p_partkey", "r.raw_reference", "r.offset_start", "r.length", "r.reference_type", "r.reference_name")

    return query


def _extract_sql(stretches: list[str | Ref]) -> str:
    before, out = "", []
    for s in stretches:
        if isinstance(s, Ref):
            name = "NULL::VARCHAR" if s.name is None else sql_text(s.name)
            out.append(
                f"SELECT p_partkey, {sql_text(s.raw)} AS raw_reference, length({sql_text(before)})::INT AS offset_start, "
                f"length({sql_text(s.raw)})::INT AS length, {s.kind}::SMALLINT AS reference_type, {name} AS reference_name FROM part"
            )
        before += s if isinstance(s, str) else s.raw
    return "\nUNION ALL ".join(out)


for _name, _stretches in EXTRACT.items():
    registered(_name, _extract_sql(_stretches), logical=False)(_extract_query(_stretches))


@registered("extract_urls", f"""
SELECT p_partkey, u.place::INT AS place, u.url
FROM part, LATERAL (VALUES (0, {sql_text('http://e.org/«p_partkey»')}), (1, {sql_text('https://f.org/«p_size»?a=«p_partkey»')})) AS u(place, url)""", logical=False)  # fmt: skip
def extract_urls(spark: SparkSession, d: str) -> DataFrame:
    """The links of a reference in order, each once, without a sentence's stop."""
    text = spark_text("<ref>http://e.org/«p_partkey», https://f.org/«p_size»?a=«p_partkey» and http://e.org/«p_partkey».</ref>")
    refs = _parts(spark, d).select("p_partkey", F.explode(parsed(text, F.lit("en.wikipedia.org"))).alias("r"))
    return refs.select("p_partkey", F.posexplode("r.urls").alias("place", "url"))


_NESTED = "<ref>{{ cite book |«p_name»| title = {{lang|de|«p_brand»}} | «p_size»}} {{page|«p_size»}}</ref>"


@registered("extract_templates", f"""
SELECT p_partkey, t.place::INT AS place, t.name AS template_name, t.k AS key, t.v AS value
FROM part, LATERAL (VALUES
  (0, 'cite book', '1', {sql_text('«p_name»')}), (0, 'cite book', 'title', {sql_text('{{lang|de|«p_brand»}}')}), (0, 'cite book', '2', {sql_text('«p_size»')}),
  (1, 'lang', '1', 'de'), (1, 'lang', '2', {sql_text('«p_brand»')}), (2, 'page', '1', {sql_text('«p_size»')})) AS t(place, name, k, v)""", logical=False)  # fmt: skip
def extract_templates(spark: SparkSession, d: str) -> DataFrame:
    """Templates in the order they open, nested ones too, and their parameters."""
    refs = _parts(spark, d).select("p_partkey", F.explode(parsed(spark_text(_NESTED), F.lit("en.wikipedia.org"))).alias("r"))
    used = refs.select("p_partkey", F.posexplode("r.templates").alias("place", "t"))
    return used.select("p_partkey", "place", "t.template_name", F.explode("t.parameters").alias("p")).select("p_partkey", "place", "template_name", "p.key", "p.value")


@registered("template_offset", f"""
SELECT p_partkey, t.place::INT AS place, t.o::INT AS offset_start
FROM part, LATERAL (VALUES
  (0, length('<ref>')), (1, length({sql_text('<ref>{{A|«p_name»}} {{B|«p_brand»}} ')})),
  (2, length({sql_text('<ref>{{A|«p_name»}} ')})), (3, length('Text '))) AS t(place, o)""", logical=False)  # fmt: skip
def template_offset(spark: SparkSession, d: str) -> DataFrame:
    """Where templates stand in the normal form: the second of all is sought as the second of its
    name; the third, of which there are two, by its text as it was; the last, not found
    there, has its reference's place."""
    text = spark_text("Text <ref>{{a|«p_name»}} {{b|«p_brand»}} {{B|«p_brand»}} {{c | «p_size»}}</ref>")
    refs = _parts(spark, d).select("p_partkey", F.explode(parsed(text, F.lit("en.wikipedia.org"))).alias("r"))
    return refs.select("p_partkey", F.posexplode("r.template_offsets").alias("place", "offset_start"))


@registered("parameter_key_md5", "SELECT normalized_sha1, parameter_key, md5(parameter_key) AS parameter_key_md5 FROM x_tdraw UNION ALL SELECT normalized_sha1, NULL, NULL FROM x_tdraw")
def parameter_key_md5(spark: SparkSession, d: str) -> DataFrame:
    rows = adapter.raw_template_data(spark, d).select("normalized_sha1", "parameter_key")
    rows = rows.unionByName(rows.withColumn("parameter_key", F.lit(None).cast("string")))
    return rows.select("normalized_sha1", "parameter_key", C.url_hash(F.col("parameter_key")).alias("parameter_key_md5"))


_WIKIS = ("en.wikipedia.org", "it.wikipedia.org", "af.wikipedia.org", "xx.example.org")


@registered("wiki_config", """
SELECT domain, section, found::BOOLEAN AS found
FROM (VALUES ('References'), ('NOTE'), ('bronne'), ('see also'), ('History')) s(section),
     LATERAL (VALUES ('en.wikipedia.org', lower(section) IN ('references', 'see also')), ('it.wikipedia.org', lower(section) = 'note'),
                     ('af.wikipedia.org', lower(section) = 'bronne'), ('xx.example.org', lower(section) IN ('references', 'see also'))) w(domain, found)""", logical=False)  # fmt: skip
def wiki_config_sections(spark: SparkSession, d: str) -> DataFrame:
    """Whether a heading names a reference section; an unknown wiki has the settings of the default one."""
    sections = ("References", "NOTE", "bronne", "see also", "History")
    return spark.createDataFrame([(w, s, s.lower() in wiki_config(w).sections) for w in _WIKIS for s in sections], "domain string, section string, found boolean")


@registered("blank_references", "SELECT p_partkey, '<ref> </ref>' AS raw_reference FROM part WHERE p_partkey % 3 = 0", logical=False)
def blank_references(spark: SparkSession, d: str) -> DataFrame:
    """References that are blank are none; an empty <ref> element is not blank."""
    text = F.when(F.col("p_partkey") % 3 == 0, F.lit("a<ref> </ref>")).when(F.col("p_partkey") % 3 == 1, F.lit(" \n "))
    refs = _parts(spark, d).select("p_partkey", F.explode(parsed(text, F.lit("en.wikipedia.org"))).alias("r"))
    return refs.select("p_partkey", "r.raw_reference").where(F.length(F.trim("raw_reference")) > 0)


# -- derived tables ---------------------------------------------------------------------------

_WIKI = D.DEFAULT_DOMAIN
_RAW = "<ref name=r«m»>{{cite_web|title= T«m» |url=http://h«h».example/«m»}}</ref>"
_FORM = '<ref name="r«m»">{{Cite web|title=T«m»|url=http://h«h».example/«m»}}</ref>'
_LINK = "http://U@p«h».example:80/x"
#: Orders as revisions: every fourth holds no reference, the others two.
REVISED = f"""
, y AS (
  SELECT revision_id, page_id, parent_revision_id, revision_timestamp, revision_id % 50 AS m, revision_id % 7 AS h, revision_id % 4 <> 0 AS cited,
         (revision_id % 3)::INT AS ns FROM x_rev
), y_ref AS (
  SELECT *, {sql_text(_RAW)} AS raw, {sql_text(_FORM)} AS form, 1::SMALLINT AS kind, {sql_text('r«m»')} AS name,
         {sql_text('http://h«h».example/«m»')} AS url, {sql_text('h«h».example')} AS host FROM y WHERE cited
  UNION ALL
  SELECT *, {sql_text(_LINK)} AS raw, {sql_text(_LINK)} AS form, 0::SMALLINT AS kind, NULL AS name, {sql_text(_LINK)} AS url, {sql_text('U@p«h».example:80')} AS host FROM y WHERE cited
)
"""


def revised(spark: SparkSession, d: str) -> DataFrame:
    """Revisions with texts."""
    rows = spread(adapter.raw_revisions(spark, d), "revision_id", 200_000).withColumns({"m": F.col("revision_id") % 50, "h": F.col("revision_id") % 7})
    text = F.when(F.col("revision_id") % 4 != 0, spark_text(f"Text {_RAW} and {_LINK}")).otherwise("no reference here")
    return rows.select(
        "page_id", (F.col("revision_id") % 3).cast("int").alias("namespace_id"), "revision_id", "parent_revision_id", "revision_timestamp", text.alias("revision_text")
    )


def derived(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    revisions = revised(spark, d)
    return D.derive(revisions, D.references(revisions), _WIKI)


_DERIVED = {
    "containers": f"SELECT '{_WIKI}' AS label",
    "domains": f"SELECT '{_WIKI}' AS value, '{_WIKI}' AS for_container_label UNION ALL SELECT host, NULL FROM y_ref",
    "documents": f"SELECT 'en' AS language_code, '{_WIKI}' AS has_container_label, page_id FROM y",
    "web_resources": f"""SELECT 'https://{_WIKI}/w/index.php?curid=' || page_id AS url, '{_WIKI}' AS domain_label, page_id AS numeric_page_id, ns AS numeric_namespace_id, page_id FROM y
        UNION ALL SELECT url, host, NULL, NULL, NULL FROM y_ref""",
    "citation_instances": "SELECT page_id, sha1(raw) AS raw_sha1, sha1(form) AS normalized_sha1, kind AS reference_type, name AS reference_name FROM y_ref",
    "normalized_citations": f"SELECT sha1(form) AS normalized_sha1, form AS reference_normalized, page_id AS appears_on_page_id, '{_WIKI}' AS appears_on_domain FROM y_ref",
    "citation_histories": "SELECT page_id, sha1(raw) AS raw_sha1, revision_id FROM y_ref",
    # A revision stands here once for each of its references, and not at all without one.
    "revisions": "SELECT revision_id, page_id, parent_revision_id, revision_timestamp FROM y_ref",
    "ncwr": "SELECT sha1(form) AS normalized_sha1, url FROM y_ref",
    "wiki_templates": f"SELECT '{_WIKI}' AS domain_label, 'Cite web' AS name FROM y_ref WHERE kind = 1",
    "template_data": f"""SELECT '{_WIKI}' AS domain_label, 'Cite web' AS template_name, sha1(form) AS normalized_sha1, (length(name) + length('<ref name="">'))::INT AS offset_start, k AS parameter_key, v AS parameter_value
        FROM y_ref, LATERAL (VALUES ('title', {sql_text('T«m»')}), ('url', url)) AS p(k, v) WHERE kind = 1""",
}


def _derived_query(table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: derived(spark, d)[table]


for _name, _sql in _DERIVED.items():
    registered(f"derive_{_name}", REVISED + _sql)(_derived_query(_name))


@registered("derive_row_counts", REVISED + "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM ({q})" for t, q in _DERIVED.items()))
def derive_row_counts(spark: SparkSession, d: str) -> DataFrame:
    revisions = revised(spark, d)
    refs = cut(D.references(revisions, _WIKI), "references")
    return D.row_counts(D.derive(revisions, refs, _WIKI))


_AS_OF = "1997-06-30 00:00:00"


@registered("page_references", REVISED + f"""
SELECT title, '{_AS_OF}' AS as_of, y.page_id, revision_id, revision_timestamp,
       CASE WHEN cited THEN {sql_text(_RAW)} || chr(10) || chr(10) || {sql_text(_LINK)} ELSE '' END AS plain
FROM y JOIN x_title USING (page_id) WHERE page_id = 22 AND revision_timestamp <= '{_AS_OF}' ORDER BY revision_timestamp DESC, revision_id DESC LIMIT 1""")  # fmt: skip
def page_references(spark: SparkSession, d: str) -> DataFrame:
    """A page's references as it stood at a time, by its title."""
    got = reports.page_references(revised(spark, d), adapter.titles(spark, d), "Customer#000000022", _AS_OF, adapter.WIKI)
    return got.select("title", "as_of", "page_id", "revision_id", "revision_timestamp", "plain")


# -- sources ----------------------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    return path


def bundle_lines(rows: DataFrame) -> DataFrame:
    """Revisions with texts of one line as rows of bundles."""
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    stamp = F.concat(F.translate("revision_timestamp", " ", "T"), F.lit("Z"))
    numbers = (("page_id", "page_id"), ("ns", "namespace_id"), ("rev_id", "revision_id"), ("parent_rev_id", "parent_revision_id"))
    head = F.concat(*[x for k, c in numbers for x in (F.lit(f" {k}="), number(c))], F.lit(" timestamp="), stamp)
    return rows.select(F.concat(F.lit("#"), head, F.lit("\n "), "revision_text").alias("value"))


@registered("bundle_source", REVISED + f"""
SELECT page_id, ns AS namespace_id, revision_id, parent_revision_id, revision_timestamp,
       CASE WHEN cited THEN {sql_text(f'Text {_RAW} and {_LINK}')} ELSE 'no reference here' END AS revision_text FROM y""")  # fmt: skip
def bundle_source(spark: SparkSession, d: str) -> DataFrame:
    """Revisions written as bundles and read again: a line for the head, then the text's lines."""
    path = _folder(spark, "bundles")
    bundle_lines(revised(spark, d)).write.option("compression", "gzip").text(path)
    return bundle.read_bundles(spark, path, suffix=".txt.gz").drop("source_file")


def _loose(spark: SparkSession, d: str) -> DataFrame:
    return adapter.raw_histories(spark, d)


@registered("staging_round_trip", "SELECT page_id, raw_sha1, revision_id FROM x_raw UNION ALL SELECT page_id, raw_sha1, revision_id FROM x_raw WHERE page_id % 2 = 0")
def staging_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Two runs staged, read together; the second try of a run takes the place of the first."""
    path, rows = _folder(spark, "staged"), _loose(spark, d)
    for stem, df in (("one", rows.limit(0)), ("one", rows), ("two", rows.where("page_id % 2 = 0"))):
        staging.write_staged({"citation_histories": df}, path, stem)
    return staging.read_staged(spark, path, "citation_histories")


@registered("jsonl_round_trip", "SELECT page_id, raw_sha1, revision_id FROM x_raw")
def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines in shards of a number of rows, with lines between them that are none."""
    path, rows = _folder(spark, "jsonl"), _loose(spark, d)
    staging.write_jsonl(rows, path, rows_a_file=20_000)
    spark.createDataFrame([("{broken",), ("",), ("  ",)], "value string").write.mode("append").option("compression", "gzip").text(path)
    return staging.read_jsonl(spark, path, rows.schema)


@registered("jsonl_lines", "SELECT count(*) + 1 AS lines, 1::BIGINT AS bad FROM x_raw")
def jsonl_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines that are not blank, and how many of them are no JSON."""
    path, rows = _folder(spark, "jsonl"), _loose(spark, d)
    staging.write_jsonl(rows, path, rows_a_file=20_000)
    spark.createDataFrame([("{broken",), ("",)], "value string").write.mode("append").option("compression", "gzip").text(path)
    return spark.createDataFrame([(staging.count_lines(spark, path), staging.bad_lines(spark, path, rows.schema))], "lines bigint, bad bigint")


@registered("compacted_histories", "SELECT page_id, raw_sha1, revision_id FROM x_raw UNION ALL SELECT page_id, raw_sha1, revision_id FROM x_raw")
def compacted_histories(spark: SparkSession, d: str) -> DataFrame:
    """All shards in one set of files, repeats kept."""
    path, rows = _folder(spark, "jsonl"), _loose(spark, d)
    staging.write_jsonl(rows.unionByName(rows), f"{path}/shards", rows_a_file=5_000)
    staging.compact_jsonl(spark, f"{path}/shards", f"{path}/whole", rows.schema, rows_a_file=50_000)
    return staging.read_jsonl(spark, f"{path}/whole", rows.schema)
