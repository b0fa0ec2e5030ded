"""The pipeline, stage by stage, against brute-force versions on its own stored inputs."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_dedup import components_by_force, lines_by_force, plain_hits, print_by_force
from tokenizers import Tokenizer

import corpus_pipeline
from tidewell.llm import quality_classifier
from tidewell.scratch import stored


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], sf_dir), f"test-{name}"))
    return docs


def test_stages_return_the_columns_of_documents(steps):
    assert all(d.columns == steps[0].columns for d in steps[1:-1])


def test_quality(spark, sf_dir, steps):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = quality_classifier.classify(steps[0], labels).where("kept")
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in steps[1].select("doc_id").collect())
    ids = {r[0] for r in steps[1].select("doc_id").collect()}
    for r in labels.collect():
        if r["quality"] == 0 or r["toxic"] == 0:
            assert (r["doc_id"] in ids) == (r["quality"] == 1)


def test_toxic_documents_go(spark, sf_dir, steps):
    toxic = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 and toxic = 1")
    assert toxic.count() and not steps[1].join(toxic, "doc_id").count()


def test_lines(steps):
    rows = steps[1].withColumn("h64", F.xxhash64("text")).collect()
    want = lines_by_force(rows, 10, "first")
    assert {r["doc_id"]: r["text"] for r in steps[2].collect()} == {r["doc_id"]: want[(r["doc_id"], r["text"])] for r in rows}


def test_near_copies(steps):
    rows = steps[2].collect()
    prints = {r["doc_id"]: print_by_force(r["text"]) for r in rows}
    roots = components_by_force(prints.values(), 3)
    first = {}
    for doc, p in sorted(prints.items()):
        first.setdefault(roots[p], doc)
    assert sorted(r["doc_id"] for r in steps[3].collect()) == sorted(first.values())


def test_leaks(spark, sf_dir, steps):
    rows = steps[3].collect()
    leaks = plain_hits(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect())
    assert {r["doc_id"] for r in steps[4].collect()} == {r["doc_id"] for r in rows} - leaks


def test_ids(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in steps[4].collect()}
    for r in steps[5].collect():
        assert r["round_trip"] and r["ids"] == library.encode(texts.pop(r["doc_id"]), add_special_tokens=False).ids
    assert not texts


def test_run_gives_the_last_stage(spark, sf_dir, steps):
    assert sorted(corpus_pipeline.run(spark, sf_dir).collect()) == sorted(steps[-1].collect())


def test_odd_and_empty_tables(spark, sf_dir, odd_docs):
    for docs in (odd_docs, odd_docs.limit(0)):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, sf_dir), "odd")
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
