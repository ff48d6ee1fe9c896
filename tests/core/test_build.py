"""Bundles to served tables on a small wiki; ingest; maintenance."""

import shutil

import pytest
import zstandard

from palimpsest.operators.dedup import parts_for
from palimpsest.plans import build, maintenance, reports
from palimpsest.schemas import SERVED, STAGED
from palimpsest.sources import bundle, staging, storage
from palimpsest.streaming.ingest import ingest_bundles, ingest_rows

REVISIONS = [
    (1, 0, 10, None, "2020-01-01 00:00:00", "A<ref name=a>{{cite web|url=http://x.example/1|title= T }}</ref>\n\n <b>"),
    (1, 0, 11, 10, "2020-01-03 00:00:00", "A<ref name=a>{{cite web|url=http://x.example/1|title= T }}</ref> http://user@Y.example:80/p"),
    (2, None, 20, None, "2020-02-01 00:00:00", "<ref>{{Cite web|title=T|url=http://x.example/1}}</ref>"),
    (3, 4, 30, None, "2020-02-02 00:00:00", "no citation here"),
]


def save(folder, name, revisions):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.mwrev.zst").write_bytes(zstandard.compress(bundle.render(revisions).encode()))


@pytest.fixture(scope="module")
def bundles(tmp_path_factory):
    folder = tmp_path_factory.mktemp("bundles")
    save(folder, "one", REVISIONS[:2])
    save(folder, "two", REVISIONS[2:])
    return folder


@pytest.fixture(scope="module")
def built(spark, bundles, tmp_path_factory):
    return build.build(spark, str(bundles), str(tmp_path_factory.mktemp("work")))


def test_parser_edges():
    text = (
        " body before any head\n# page_id=1 ns=0 rev_id=5 parent_rev_id= timestamp=2020-01-01T00:00:00Z rev_id=6\n one\n \nnot a body line\n  two\n"
        "# page_id=2 rev_id=7\n"
    )
    got = list(bundle.parse_lines(text.split("\n")))
    assert got == [(1, 0, 6, None, "2020-01-01 00:00:00", "one\n\n two"), (2, None, 7, None, "", "")]
    assert list(bundle.parse_lines([])) == []
    with pytest.raises(ValueError):
        list(bundle.parse_lines(["# page_id=x"]))


def test_both_readers_agree(spark, bundles):
    bundle.register(spark)
    a = {tuple(r) for r in spark.read.format("mwrev").load(str(bundles)).collect()}
    b = {tuple(r)[:-1] for r in bundle.read_bundles(spark, str(bundles)).collect()}
    assert a == b == set(REVISIONS)


def test_page_as_of(spark, bundles):
    revisions = bundle.read_bundles(spark, str(bundles))
    titles = spark.createDataFrame([("en.wikipedia.org", "One", 1), ("en.wikipedia.org", "Three", 3)], "domain string, title string, page_id int")
    got = reports.page_references(revisions, titles, "One", "2020-01-02T00:00:00Z").collect()
    assert [(r.page_id, r.revision_id, r.revision_timestamp, r.as_of) for r in got] == [(1, 10, "2020-01-01 00:00:00", "2020-01-02 00:00:00")]
    assert got[0].plain == "<ref name=a>{{cite web|url=http://x.example/1|title= T }}</ref>"
    now = reports.page_references(revisions, titles, "One").first()
    assert now.revision_id == 11 and now.plain.split("\n\n")[1] == "http://user@Y.example:80/p"
    assert reports.page_references(revisions, titles, "Three").first().plain == ""
    assert reports.page_references(revisions, titles, "Nobody").count() == 0
    assert reports.page_references(revisions, titles, "One", "2019-01-01").count() == 0
    with pytest.raises(ValueError):
        reports.page_references(revisions, titles, "")


def test_staged_and_deduped(spark, built):
    root = built.source.replace("deduped", "staged")
    staged = build.staged_tables(spark, root)
    assert {n: df.schema for n, df in staged.items()} == STAGED
    # A revision without a reference has a document, and no row among revisions.
    assert {r.page_id for r in staged["documents"].collect()} == {1, 2, 3}
    assert {r.revision_id for r in staged["revisions"].collect()} == {10, 11, 20}
    assert {r.value for r in staged["domains"].collect()} == {"en.wikipedia.org", "x.example", "user@Y.example:80"}
    assert spark.read.parquet(f"{built.source}/citation_histories").count() == 4
    # Two raw forms share one normal form.
    texts = {r.reference_normalized for r in spark.read.parquet(f"{built.source}/normalized_citations").collect()}
    assert '<ref name="a">{{Cite web|title=T|url=http://x.example/1}}</ref>' in texts and len(texts) == 3


def test_served(spark, built):
    assert {n: built.served(n).schema for n in SERVED} == SERVED
    counts = {n: built.served(n).count() for n in ("documents", "citation_instances", "citation_history", "revisions", "wiki_templates", "template_data")}
    assert counts == {"documents": 3, "citation_instances": 3, "citation_history": 4, "revisions": 3, "wiki_templates": 1, "template_data": 4}
    assert maintenance.violations(spark, built.root).count() == 0
    assert build.missed_histories(built) == 0


def test_second_load_changes_nothing(spark, built):
    before = {n: sorted(map(str, built.served(n).collect())) for n in SERVED}
    built.load()
    assert before == {n: sorted(map(str, built.served(n).collect())) for n in SERVED}


def test_load_of_a_part_finds_its_parents(spark, built):
    built.load(["normalized_citations", "citation_instances"])
    assert built.served("citation_instances").count() == 3
    with pytest.raises(ValueError):
        built.load(["nothing"])


def test_ingest_takes_each_file_once(spark, tmp_path):
    folder, work = tmp_path / "in", tmp_path / "work"
    save(folder, "one", REVISIONS[:2])
    ingest_bundles(spark, str(folder), str(work))
    loader = build.Loader(spark, "", str(work / "served"))
    ids = {r.raw_sha1: r.id for r in loader.served("citation_instances").collect()}
    assert len(ids) == 2
    save(folder, "two", REVISIONS[2:])
    ingest_bundles(spark, str(folder), str(work))
    now = {r.raw_sha1: r.id for r in loader.served("citation_instances").collect()}
    assert len(now) == 3 and all(now[k] == v for k, v in ids.items())
    assert loader.served("citation_history").count() == 4
    assert sorted(p.name for p in (work / "batches").iterdir()) == ["0", "1"]


def test_ingest_rows_merges(spark, tmp_path):
    for i, rows in enumerate(([("a", None), ("b", "g")], [("a", "h"), ("c", None)])):
        spark.createDataFrame(rows, STAGED["domains"]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ingest_rows(spark, str(tmp_path / "in"), "domains", str(tmp_path / "out"), str(tmp_path / "cp"), ["value"], "coalesce")
    assert {tuple(r) for r in storage.read_table(spark, str(tmp_path / "out"), STAGED["domains"]).collect()} == {("a", "h"), ("b", "g"), ("c", None)}


def test_maintenance(spark, tmp_path):
    root = str(tmp_path)
    assert set(maintenance.create(spark, root)) == set(SERVED)
    assert maintenance.create(spark, root) == []
    spark.createDataFrame([(1, "x", None, None)], SERVED["containers"]).write.mode("overwrite").parquet(f"{root}/containers")
    maintenance.truncate(spark, root, "containers")
    assert storage.read_table(spark, f"{root}/containers", SERVED["containers"]).count() == 0
    maintenance.drop(spark, root, "domains")
    assert not (tmp_path / "domains").exists() and (tmp_path / "containers").exists()
    maintenance.drop(spark, root)
    assert not (tmp_path / "containers").exists()
    with pytest.raises(ValueError):
        maintenance.create(spark, root, "no such table")


def test_violations_are_found(spark, tmp_path):
    root = str(tmp_path)
    maintenance.create(spark, root)
    spark.createDataFrame([(1, "v", 9, None, None, None), (2, "v", None, None, None, None)], SERVED["domains"]).write.mode("overwrite").parquet(f"{root}/domains")
    assert {r.check for r in maintenance.violations(spark, root).collect()} == {"domains: repeated key", "domains.for_container: no containers"}


def test_buckets_join_without_a_shuffle(spark):
    a = spark.createDataFrame([(i % 7, i) for i in range(50)], "page_id int, revision_id bigint")
    for name in ("bucket_a", "bucket_b"):
        maintenance.bucket_by_page(a, name, buckets=4)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = spark.table("bucket_a").join(spark.table("bucket_b"), ["page_id", "revision_id"])
        assert joined.count() == 50
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
        for name in ("bucket_a", "bucket_b"):
            spark.sql(f"drop table {name}")


def test_jsonl(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.jsonl").write_text('{"value": "a", "for_container_label": null}\n\nbroken {\n{"value": "b"}\n')
    (source / "b.jsonl").write_text("")
    schema = STAGED["domains"]
    assert {r.value for r in staging.read_jsonl(spark, str(source), schema).collect()} == {"a", "b"}
    assert staging.bad_lines(spark, str(source), schema) == 1
    assert staging.count_lines(spark, str(source)) == 3 and staging.count_lines(spark, str(tmp_path / "none")) == 0
    staging.compact_jsonl(spark, str(source), str(tmp_path / "out"), schema, rows_a_file=1)
    assert staging.read_jsonl(spark, str(tmp_path / "out"), schema).count() == 2
    assert staging.read_staged(spark, str(tmp_path), "domains") is None
    with pytest.raises(ValueError):
        staging.read_staged(spark, str(tmp_path), "nothing")
    shutil.rmtree(source)


def test_parts():
    assert [parts_for(n) for n in (0, 1, 5_000_000, 5_000_001, 20_000_001)] == [1, 1, 1, 2, 8]


def rows_of(spark, path):
    return sorted(tuple(r) for r in storage.read_table(spark, path, STAGED["domains"]).collect())


def domains(spark, *values):
    return spark.createDataFrame([(v, None) for v in values], STAGED["domains"])


def test_tables_change_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert rows_of(spark, path) == []
    storage.append_table(domains(spark, "a"), path)
    storage.append_table(domains(spark, "b"), path)
    assert rows_of(spark, path) == [("a", None), ("b", None)]
    # A table may be read while it is replaced, by itself and by those that began before.
    before = storage.read_table(spark, path, STAGED["domains"])
    storage.replace_table(before.where("value = 'b'").unionByName(domains(spark, "c")), path)
    assert rows_of(spark, path) == [("b", None), ("c", None)] and before.count() == 2

    class Refusing:
        """A file system whose renames fail without an error, as Hadoop's do."""

        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return (lambda *_: False) if name == "rename" else getattr(self.fs, name)

    real = storage._fs
    with monkeypatch.context() as m:
        m.setattr(storage, "_fs", lambda spark, p: (Refusing(real(spark, p)[0]), real(spark, p)[1]))
        for change in (storage.append_table, storage.replace_table):
            with pytest.raises(RuntimeError):
                change(domains(spark, "lost"), path)
    assert rows_of(spark, path) == [("b", None), ("c", None)]
    # A run that dies once its rows are written, and one that finds the table changed.
    with monkeypatch.context() as m:
        dead = domains(spark, "dead")
        m.setattr(storage.json, "dumps", lambda x, **k: 1 / 0 if isinstance(x, list) else "")
        with pytest.raises(ZeroDivisionError):
            storage.append_table(dead, path)
    assert rows_of(spark, path) == [("b", None), ("c", None)]
    states, calls = storage._states, []
    with monkeypatch.context() as m:
        m.setattr(storage, "_states", lambda *a: states(*a) if not calls.append(1) and len(calls) < 3 else ["_rows-999"])
        with pytest.raises(RuntimeError, match="another run"):
            storage.append_table(domains(spark, "late"), path)
    storage.append_table(domains(spark, "d"), path)
    assert rows_of(spark, path) == [("b", None), ("c", None), ("d", None)]
    # Nothing is left of what no state or the last one names.
    left = {p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")}
    assert len([n for n in left if n.startswith("_rows-")]) == 2 and len([n for n in left if n.startswith("rows-")]) == 2


def test_a_folder_without_a_list_is_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    domains(spark, "a").write.parquet(path)
    storage.append_table(domains(spark, "b"), path)
    assert rows_of(spark, path) == [("a", None), ("b", None)]
    storage.append_table(domains(spark, "c"), path)
    assert rows_of(spark, path) == [("a", None), ("b", None), ("c", None)]
    assert not list((tmp_path / "t").glob("*.parquet"))


def test_loads_write_what_changes(spark, bundles, tmp_path):
    """New keys are appended, equal rows leave a table alone, a changed row rewrites its table."""
    loader = build.build(spark, str(bundles), str(tmp_path / "work"))
    state = lambda name: storage._states(spark, f"{loader.root}/{name}")
    before = {name: state(name) for name in build.LOAD_ORDER}
    loader.load()
    assert before == {name: state(name) for name in build.LOAD_ORDER}
    more = tmp_path / "more"
    save(more, "three", [(4, 0, 40, None, "2020-03-01 00:00:00", REVISIONS[0][5])])
    build.stage(spark, str(more), str(tmp_path / "staged"))
    build.dedup(spark, str(tmp_path / "staged"), str(tmp_path / "deduped"))
    again = build.Loader(spark, str(tmp_path / "deduped"), loader.root)
    again.load()
    after = {name: state(name) for name in build.LOAD_ORDER}
    assert after["containers"] == before["containers"] and after["wiki_templates"] == before["wiki_templates"]
    held = {n: storage._listed(spark, f"{loader.root}/{n}", after[n][-1]) for n in ("citation_history", "normalized_citations")}
    # The citation is known, its page is another now: that table is one new folder; histories have one more.
    assert len(held["citation_history"]) == 2 and len(held["normalized_citations"]) == 1
    assert again.served("citation_history").count() == 5 and maintenance.violations(spark, loader.root).count() == 0


def test_a_build_that_died_goes_on_where_it_was(spark, bundles, tmp_path, monkeypatch):
    work = str(tmp_path / "work")
    steps, load = [], build.Loader.load

    def dying(self, tables=None):
        steps.append(tables)
        if tables == ["revisions"]:
            raise KeyboardInterrupt
        load(self, tables)

    monkeypatch.setattr(build.Loader, "load", dying)
    with pytest.raises(KeyboardInterrupt):
        build.build(spark, str(bundles), work)
    monkeypatch.setattr(build.Loader, "load", lambda self, tables=None: (steps.append(tables), load(self, tables)))
    monkeypatch.setattr(build, "stage", lambda *_: pytest.fail("it is staged"))
    monkeypatch.setattr(build, "write_deduped", lambda *_: pytest.fail("it is deduplicated"))
    loader = build.build(spark, str(bundles), work, resume=True)
    at = build.LOAD_ORDER.index("revisions")
    assert steps == [[n] for n in (*build.LOAD_ORDER[: at + 1], *build.LOAD_ORDER[at:])]
    assert loader.served("citation_history").count() == 4 and maintenance.violations(spark, loader.root).count() == 0


@pytest.mark.parametrize("policy,expected", [("replace", [(1, "x", None), (2, "b", 2), (3, "n", 3)]), ("coalesce", [(1, "x", 1), (2, "b", 2), (3, "n", 3)]), ("ignore", [(1, "a", 1), (2, "b", 2), (3, "n", 3)])])
def test_merge_statement(policy, expected):
    import duckdb

    con = duckdb.connect()
    con.execute("create table t (k int primary key, name varchar, n int); insert into t values (1, 'a', 1), (2, 'b', 2)")
    con.execute("create table side as select * from (values (1, 'x', null::int), (3, 'n', 3)) v(k, name, n)")
    con.execute(staging.merge_statement("t", "side", ["k", "name", "n"], ["k"], policy))
    assert con.execute("select * from t order by k").fetchall() == expected
