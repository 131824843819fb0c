"""The registered queries and the pipeline's stages."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tools.compare import compare, duck
from treadle.llm import jaccard, pii, quality, queries, toxicity

FOLDER = os.environ.get("TREADLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, FOLDER, entry.oracle_sql().get(name)).startswith(
        "ok" if name in entry.oracle_sql() else "rows")


def test_every_operator_is_registered():
    numbers = sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        docs = seen[name] = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
        if name == "quality rules":
            judged = quality.assess(spark, before, labels)
            assert sorted(r.doc_id for r in docs.collect()) == sorted(r.id for r in judged.where("kept").collect())
        elif name == "toxicity":
            lexicon = queries.toxic_lexicon(spark, before, FOLDER)
            kept = {r.doc_id for r in before.collect() if lexicon.score(r.text) < 0.5}
            assert {r.doc_id for r in docs.collect()} == kept
        elif name == "near duplicates":
            groups = jaccard.similar_documents(spark, before).collect()
            assert sorted(r.doc_id for r in docs.collect()) == sorted({r.component_id for r in groups})
        elif name == "personal data":
            texts = {r.doc_id: r.text for r in before.collect()}
            assert {r.doc_id: r.text for r in docs.collect()} == {i: pii.redact_text(t) for i, t in texts.items()}
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        else:
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()}
    assert seen["personal data"].count() < spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_run_is_its_stages(spark, tmp_path):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns[0] == "doc_id" and got.count() > 0


def test_toxicity_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    scored = queries.op7_toxicity(spark, FOLDER).join(labels, "doc_id").where("toxic is not null").collect()
    assert scored and sum(r.predicted == r.toxic for r in scored) / len(scored) > 0.7
    assert isinstance(queries.toxic_lexicon(spark, docs, FOLDER), toxicity.Lexicon)
