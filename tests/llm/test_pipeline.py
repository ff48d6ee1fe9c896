"""The corpus pipeline, stage by stage, against plain versions on each stage's own input."""

import struct
from collections import defaultdict

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from palimpsest.llm import ftrl_toxicity, queries, rff_quality

from .conftest import SCHEMA, TINY, awkward_rows
from .test_mixing import WORD, plain_targets
from .test_ngram_join import brute


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input of each stage and the last output, as written."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, TINY).write.parquet(str(folder / str(k)))
        docs = spark.read.parquet(str(folder / str(k)))
        out.append(docs)
    return out


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_columns_stay_until_the_last(stages):
    assert all(df.dtypes == stages[0].dtypes for df in stages[:-1])
    assert stages[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]


@pytest.mark.parametrize("k,op,label,keeps", [(0, rff_quality, "quality", 1), (1, ftrl_toxicity, "toxic", 0)])
def test_classified(spark, stages, k, op, label, keeps):
    labels = spark.read.parquet(f"{TINY}/labels.parquet")
    scored = op.score(stages[k], op.fit(stages[k], labels))
    keep = {r.doc_id for r in scored.collect() if r.predicted == keeps}
    assert rows(stages[k + 1]) == rows(stages[k].where(F.col("doc_id").isin(list(keep))))
    marks = stages[k].join(labels, "doc_id").select("doc_id", label).collect()
    good, bad = [{r.doc_id for r in marks if r[label] == y} for y in (keeps, 1 - keeps)]
    assert len(good & keep) >= 0.97 * len(good) and len(bad & keep) <= 0.25 * len(bad)


def test_one_of_each_group(stages):
    given = [tuple(r) for r in stages[2].select("doc_id", "text").collect()]
    classes = {eval(x)[1] for x in brute(given)}
    assert rows(stages[3]) == rows(stages[2].where(F.col("doc_id").isin(list(classes))))


def test_mixed_near_targets(stages):
    sizes, words = defaultdict(int), defaultdict(int)
    for r in stages[3].collect():
        sizes[r.source] += len(WORD.findall(r.text))
    for r in stages[4].collect():
        words[r.source] += len(WORD.findall(r.text))
    for s, target in plain_targets(sizes).items():
        assert abs(words[s] - target) <= 0.02 * target + 16


def test_encoded_as_the_library_does(stages):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    expected = []
    for r in stages[4].collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        expected.append(repr((r.doc_id, struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False))))
    assert sorted(repr((r.doc_id, bytes(r.ids), r.decoded)) for r in stages[5].collect()) == sorted(expected)


def test_run_is_its_stages(spark, stages):
    assert rows(corpus_pipeline.run(spark, TINY)) == rows(stages[-1])


def test_awkward_documents_pass_every_stage(spark):
    docs = spark.createDataFrame(awkward_rows(), SCHEMA)
    for df in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, df, TINY).count() >= 0, name


def test_registered():
    found = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 11)]
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
