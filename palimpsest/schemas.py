"""Declared schemas of the staged and the served tables; nothing is inferred.

``STAGED`` is in load order.  A table's key is what makes a row one of a kind, and
``REQUIRED`` columns are not null after deduplication.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import ArrayType, IntegerType, LongType, ShortType, StringType, StructField, StructType

_TYPES = {"string": StringType(), "int": IntegerType(), "bigint": LongType(), "smallint": ShortType()}


def struct(columns: str) -> StructType:
    """A flat schema from "name type, ...", without a running session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(","))])


DDL = {
    "containers": "label string",
    "domains": "value string, for_container_label string",
    "documents": "language_code string, has_container_label string, page_id int",
    "web_resources": "url string, domain_label string, numeric_page_id int, numeric_namespace_id int, page_id int",
    "normalized_citations": "normalized_sha1 string, reference_normalized string, appears_on_page_id int, appears_on_domain string",
    "citation_instances": "page_id int, raw_sha1 string, normalized_sha1 string, reference_type smallint, reference_name string",
    "revisions": "revision_id bigint, page_id int, parent_revision_id bigint, revision_timestamp string",
    "citation_histories": "page_id int, raw_sha1 string, revision_id bigint",
    "ncwr": "normalized_sha1 string, url string",
    "wiki_templates": "domain_label string, name string",
    "template_data": (
        "domain_label string, template_name string, normalized_sha1 string, offset_start int, parameter_key string, "
        "parameter_value string"
    ),
}
STAGED: dict[str, StructType] = {name: struct(ddl) for name, ddl in DDL.items()}


@dataclass(frozen=True)
class Identity:
    """``whole``: how a row of several with one key is chosen, intact or column by column."""

    key: tuple[str, ...]
    required: tuple[str, ...]
    whole: bool = True


IDENTITY: dict[str, Identity] = {
    "containers": Identity(("label",), ("label",)),
    "domains": Identity(("value",), ("value",), whole=False),
    "documents": Identity(("has_container_label", "page_id"), ("page_id",)),
    "web_resources": Identity(("url",), ("url",), whole=False),
    "normalized_citations": Identity(("normalized_sha1",), ("normalized_sha1",)),
    "citation_instances": Identity(("page_id", "raw_sha1"), ("page_id", "raw_sha1")),
    "revisions": Identity(("revision_id",), ("revision_id",)),
    "citation_histories": Identity(("page_id", "raw_sha1", "revision_id"), ("page_id", "raw_sha1", "revision_id")),
    "ncwr": Identity(("normalized_sha1", "url"), ("normalized_sha1", "url")),
    "wiki_templates": Identity(("domain_label", "name"), ("domain_label", "name")),
    "template_data": Identity(
        ("domain_label", "template_name", "normalized_sha1", "offset_start", "parameter_key"), ("domain_label", "template_name")
    ),
}

#: Served tables: natural keys beside surrogate ids.
SERVED_DDL = {
    "containers": "id int, label string, wikidata_id string, librarybase_id string",
    "domains": "id int, value string, for_container int, parent_domain int, wikidata_id string, librarybase_id string",
    "documents": "id int, title string, language_code string, has_container int, page_id int",
    "web_resources": (
        "id bigint, url string, url_hash string, domain_id int, numeric_page_id int, numeric_namespace_id int, "
        "instance_of_document int, is_archive_of bigint"
    ),
    "normalized_citations": "id int, normalized_sha1 string, reference_normalized string, appears_on_article int",
    "citation_instances": "id bigint, page_id int, raw_sha1 string, normalized_id int, reference_type smallint, reference_name string",
    "revisions": "revision_id bigint, page_id int, parent_revision_id bigint, revision_timestamp string",
    "citation_history": "page_id int, citation_instance_id bigint, revision_id bigint",
    "normalized_citation_web_resources": "normalized_id int, web_resource_id bigint",
    "wiki_templates": "id int, domain_id int, name string, wikidata_id string",
    "template_data": (
        "wiki_template_id int, normalized_id int, offset_start int, parameter_key string, parameter_key_md5 string, "
        "parameter_value string"
    ),
    "revision_bundles": "id int, file_path string",
}
SERVED: dict[str, StructType] = {name: struct(ddl) for name, ddl in SERVED_DDL.items()}

REVISION = struct(
    "page_id int, namespace_id int, revision_id bigint, parent_revision_id bigint, revision_timestamp string, revision_text string"
)
_PARAMETER = struct("key string, value string")
_TEMPLATE = struct("template_name string, full_text string").add("parameters", ArrayType(_PARAMETER))
#: An extracted reference, its normal form, and the places of its templates there.
REFERENCE = (
    struct("raw_reference string, offset_start int, length int, reference_type smallint, reference_name string")
    .add("urls", ArrayType(StringType()))
    .add("templates", ArrayType(_TEMPLATE))
    .add("normalized", StringType())
    .add("template_offsets", ArrayType(IntegerType()))
)
