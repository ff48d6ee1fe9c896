"""Registered queries against their SQL, and properties that tie them to each other."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from palimpsest.functions import columns as C
from palimpsest.operators import lifecycle as L
from palimpsest.operators import upsert as U
from palimpsest.operators.dedup import dedup_table, representative
from palimpsest.operators.keys import extend_ids
from palimpsest.plans import adapter, registry, reports
from palimpsest.schemas import STAGED

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, sql, name):
    df = registry.QUERIES[name](spark, SF)
    cursor = sql.cursor().execute(registry.SQL[name])
    columns = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, expected))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def small(spark):
    """A stands in all revisions of page 1, B in the first, C in the first and the last by time."""
    revisions = spark.createDataFrame([(10, 1, None, "2020-01-01"), (11, 1, 10, "2020-01-03"), (12, 1, 11, "2020-01-02")], STAGED["revisions"])
    stands = {"A": (10, 11, 12), "B": (10,), "C": (10, 12)}
    histories = spark.createDataFrame([(1, k, r) for k, v in stands.items() for r in (*v, v[0])], STAGED["citation_histories"])
    instances = spark.createDataFrame([(1, k, "n" + k, 1, None) for k in stands], STAGED["citation_instances"])
    return histories, revisions, instances


def test_lifecycle_by_hand(small):
    rows = {r.raw_sha1: r for r in L.lifecycle(*small).where("revision_id = 10").collect()}
    got = {k: (r.first_seen_id, r.last_seen_id, r.last_seen_ts, r.appearance_count, r.currently_visible, r.removed_at_id) for k, r in rows.items()}
    assert got == {
        "A": (10, 12, "2020-01-03", 3, True, None),
        "B": (10, 10, "2020-01-01", 1, False, 11),
        "C": (10, 12, "2020-01-02", 2, True, 11),
    }


def test_presence_by_hand(small):
    rows = sorted(tuple(r) for r in L.presence_intervals(small[0], small[1]).collect())
    assert rows == [(1, "A", 10, 12, 3), (1, "B", 10, 10, 1), (1, "C", 10, 10, 1), (1, "C", 12, 12, 1)]


def test_page_query_is_the_whole_filtered(spark):
    t = adapter.tables(spark, SF)
    page = reports.citations_at(t, registry.PAGE).drop("reference_normalized", "reference_type")
    last = t.revisions.where(F.col("page_id") == registry.PAGE).agg(F.max("revision_id")).first()[0]
    whole = reports.lifecycle_all(t).where((F.col("page_id") == registry.PAGE) & (F.col("revision_id") == last)).select(*page.columns)
    assert sorted(map(str, page.collect())) == sorted(map(str, whole.collect()))


def test_bad_arguments(spark):
    t = adapter.tables(spark, SF)
    for call in (
        lambda: reports.article(t, ""),
        lambda: reports.article_revisions(t, 1, limit=-1),
        lambda: reports.template_report(t, "x", "", "v"),
        lambda: reports.template_report(t, "x", "k", None),
        lambda: reports.citations_at(t, registry.PAGE, -5, strict=True),
        lambda: U.upsert(t.titles, t.titles, ["page_id"], "no policy"),
        lambda: dedup_table(t.titles, "no table"),
    ):
        with pytest.raises(ValueError):
            call()
    assert reports.article(t, "https://nowhere.example").count() == 0
    assert reports.template_report_raw(t, "no template", "k", "").count() == 0


def test_representative_keeps_a_row_whole(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "z"), (1, 5, None), (None, 1, "x")], "k int, n int, s string")
    assert [tuple(r) for r in representative(df, ("k",), ("k",)).collect()] == [(1, 5, "z")]
    assert [tuple(r) for r in representative(df, ("k",), ("k",), whole=False).collect()] == [(1, 5, "a")]
    assert representative(df.limit(0), ("k",)).count() == 0


def test_dedup_is_idempotent(spark):
    rows = adapter.raw_instances(spark, SF).select("page_id", "raw_sha1", "normalized_sha1", "reference_type", "reference_name")
    once = dedup_table(rows, "citation_instances")
    assert sorted(map(str, once.collect())) == sorted(map(str, dedup_table(once, "citation_instances").collect()))


def test_upsert_of_batches_with_repeats(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, n string, s string")
    new = spark.createDataFrame([(1, None, "p", 1), (1, "c", None, 2), (3, None, None, 1), (None, "z", "z", 1)], "k int, n string, s string, o int")
    got = lambda policy: sorted(tuple(r) for r in U.upsert(old, new, ["k"], policy, order=F.col("o")).collect())
    assert got(U.COALESCE) == [(1, "c", "p"), (2, "b", "x"), (3, None, None)]
    assert got(U.REPLACE) == [(1, "c", None), (2, "b", "x"), (3, None, None)]
    assert got(U.IGNORE) == [(1, "a", None), (2, "b", "x"), (3, None, None)]


def test_ids_stay_and_new_ones_follow(spark):
    old = spark.createDataFrame([("b", 7), ("d", 3)], "k string, id int")
    new = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "k string")
    got = {r.k: r.id for r in extend_ids(old, new, ["k"]).collect()}
    assert got == {"b": 7, "d": 3, "a": 8, "c": 9}


@pytest.mark.parametrize(
    "url,domain,title,is_curid",
    [
        ("https://w.example.org/wiki/A_b%20c?x=1#y", "w.example.org", "A_b%20c", False),
        ("https://w.example.org/w/index.php?title=A%20b&curid=3", "w.example.org", "A b", False),
        ("https://w.example.org/w/index.php?curid=3", "w.example.org", None, True),
        ("https://w.example.org/wiki/index.php", "w.example.org", "index.php", False),
        ("https://w.example.org/other", "w.example.org", None, False),
        ("no url", None, None, False),
    ],
)
def test_wiki_urls(spark, url, domain, title, is_curid):
    p = spark.createDataFrame([(url,)], "u string").select(C.parsed_wiki_url(F.col("u")).alias("p")).first()["p"]
    assert (p["domain"], p["title"], p["is_curid"]) == (domain, title, is_curid)


def test_scalar_edges(spark):
    df = spark.createDataFrame([("species.wikimedia.org",), ("commons.wikimedia.org",), ("fr.wikivoyage.org",), ("localhost",)], "d string")
    assert [r[0] for r in df.select(C.domain_family(F.col("d"))).collect()] == ["Wikispecies", "Wikimedia Commons", "Wikivoyage", "Localhost"]
    urls = spark.createDataFrame([("HTTP://u:p@H.example:8/x",), ("//h/x",), ("mailto:a@b",), (None,)], "u string")
    assert [r[0] for r in urls.select(C.netloc(F.col("u"))).collect()] == ["u:p@H.example:8", "h", "", None]
    names = spark.createDataFrame([("_cite_web ",), ("",), (None,)], "n string")
    assert [r[0] for r in names.select(C.template_name_norm(F.col("n"))).collect()] == ["Cite web", "", None]
    kinds = spark.createDataFrame([(1,), (9,), (None,)], "k smallint")
    assert [r[0] for r in kinds.select(C.type_label(F.col("k"))).collect()] == ["inline", "9", None]
