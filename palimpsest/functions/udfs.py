"""The wikitext scanner on columns, in Arrow batches, and its SQL names."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StringType

from ..schemas import REFERENCE
from .wikitext import extract_references, normalize_wikitext, template_name, template_offset


#: Rows of texts made of a table's columns that one task parses.
ROWS_A_TASK = 20_000
#: Longer texts are not remembered.  A page's revisions hold the same references over and over.
_LONG = 2000


def spread(df: DataFrame, key: str, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """Rows dealt out by a key for work in Python: a table in one file of few bytes would be one task's."""
    parts = -(-df.count() // rows_a_task)
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), key)


@lru_cache(4096)
def _known(text: str) -> str:
    return normalize_wikitext(text)


def references_with_normal_form(text: str | None, domain: str | None) -> list[dict]:
    """Extracted references that are not blank, each with its normal form and the places
    of its templates there."""
    out = []
    for ref in extract_references(text, True, domain or ""):
        if not ref["raw_reference"].strip():
            continue
        normal = (_known if ref["length"] <= _LONG else normalize_wikitext)(ref["raw_reference"])
        seen: dict[str, list[int]] = {}
        places = [
            template_offset(normal, template_name(t["template_name"]), i, t["full_text"], ref["offset_start"], seen)
            for i, t in enumerate(ref["templates"], 1)
        ]
        out.append(ref | {"normalized": normal, "template_offsets": places})
    return out


@lru_cache(1024)
def _parsed(text: str, domain: str | None) -> list[dict]:
    return references_with_normal_form(text, domain)


_REFERENCES = to_arrow_type(ArrayType(REFERENCE))


@F.arrow_udf(ArrayType(REFERENCE))
def parse_refs(texts: pa.Array, domains: pa.Array) -> pa.Array:
    pairs = zip(texts.to_pylist(), domains.to_pylist())
    return pa.array([(_parsed if t and len(t) <= _LONG else references_with_normal_form)(t, d) for t, d in pairs], _REFERENCES)


@F.arrow_udf(StringType())
def normalize(texts: pa.Array) -> pa.Array:
    return pa.array([normalize_wikitext(t) for t in texts.to_pylist()], pa.string())


def parsed(text: Column, domain: Column) -> Column:
    """Array of REFERENCE structs of a text; empty for null."""
    return parse_refs(text, domain)


def register(spark: SparkSession) -> None:
    """Make parse_refs and normalize_wikitext callable from SQL."""
    spark.udf.register("parse_refs", parse_refs)
    spark.udf.register("normalize_wikitext", normalize)
