"""The corpus pipeline: each stage's decision on a planted table, and a whole run."""

import random

import corpus_pipeline
from llm_fixtures import SF001, awkward, rows, word_text, DOC_SCHEMA
from netsieve.llm.common import load


def test_stage_names_and_contract(spark):
    assert len(corpus_pipeline.STAGES) == 5
    docs = load(spark, SF001, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.where("doc_id < 20"), SF001).columns == docs.columns


def test_planted(spark):
    rng = random.Random(9)
    item = load(spark, SF001, "benchmark").orderBy("item_id").first()["text"]
    base = word_text(rng, 120, 3000)
    near = base.split()
    near[40] = "changed"
    clean = [word_text(rng, 200, 3000) for _ in range(6)]
    planted = [base, " ".join(near), base, word_text(rng, 30) + " " + item + " " + word_text(rng, 30), "mail me a.b@c.de " + word_text(rng, 100, 3000),
               "12345 !!!", None, ""]
    docs = spark.createDataFrame(rows(clean + planted), DOC_SCHEMA).repartition(3)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF001)
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert set(kept["language_id"]) == set(range(11))
    assert set(kept["near_duplicates"]) == {0, 1, 2, 3, 4, 5, 6, 9, 10}
    assert set(kept["decontamination"]) == {0, 1, 2, 3, 4, 5, 6, 10}
    assert kept["personal_data"][10].startswith("mail me [EMAIL] ")
    assert [kept["personal_data"][i] for i in range(6)] == clean
    mix = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    assert {r["doc_id"] for r in mix} == set(kept["personal_data"]) and all(r["taken"] <= 2 * r["size"] for r in mix)


def test_awkward_rows_pass_through_all_stages(spark):
    docs = spark.createDataFrame(rows(awkward()), DOC_SCHEMA).repartition(3)
    for stage_docs in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            stage_docs = stage(spark, stage_docs, SF001)
        assert stage_docs.count() >= 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF001)
    n = load(spark, SF001, "documents").count()
    assert 0.5 * n < out.count() <= n and "taken" in out.columns
    assert sorted(out.collect()) == sorted(corpus_pipeline.run(spark, SF001).collect())
