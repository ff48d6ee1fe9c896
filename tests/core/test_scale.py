"""Work that must not stay in one task, or grow in one, however few files a table has."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["extract_types", "template_offset", "extract_templates", "extract_ref_self_closing", "normalize_wikitext", "derive_ncwr"])
def test_texts_of_one_file_are_parsed_in_many_tasks(spark, name):
    rows = entry.queries()[name](spark, SF)
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() >= spark.sparkContext.defaultParallelism > 1


@pytest.mark.parametrize("name", ["citation_stats", "removed_at"])
def test_parts_follow_the_rows(spark, monkeypatch, name):
    """A task's rows do not grow with the table."""
    from palimpsest.plans import adapter

    expected = sorted(map(tuple, entry.queries()[name](spark, SF).collect()), key=repr)
    monkeypatch.setattr(adapter, "ROWS_A_PART", 500)
    rows = entry.queries()[name](spark, SF)
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 8
    assert sorted(map(tuple, rows.collect()), key=repr) == expected


def test_many_rows_are_not_sent_through_the_driver(spark, monkeypatch):
    """A look-up of more rows than every task may be sent meets its rows in a shuffle."""
    from palimpsest.operators import keys

    rows = spark.createDataFrame([("a",), ("b",)], "host string")
    ids = spark.createDataFrame([(i, chr(97 + i)) for i in range(20)], "id bigint, value string")
    plan = lambda: keys.resolve(rows, ids, {"host": "value"}, "domain_id", keep_missing=True)._jdf.queryExecution().sparkPlan().toString()
    monkeypatch.setattr(keys, "FEW", 10)
    assert "SortMergeJoin" in plan()
    got = keys.resolve(rows, ids, {"host": "value"}, "domain_id", keep_missing=True).select("host", "domain_id").collect()
    assert sorted(map(tuple, got)) == [("a", 0), ("b", 1)]
