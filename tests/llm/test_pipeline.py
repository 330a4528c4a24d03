"""The registered queries against their SQL, held-out accuracy, and the stages of the pipeline."""

import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from checking import connect, difference
from shelfline.llm import decontaminate, jaccard, mixing, quality, secrets
from shelfline.llm.sql import SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_all_are_registered():
    names = list(contract.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark):
    assert difference(contract.queries()[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) is None


@pytest.mark.parametrize("name, label, least", [("op3_quality", "quality", 0.9), ("op7_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(name, label, least, spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in contract.queries()[name](spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert rows and sum(r.predicted == labels[r.doc_id] for r in rows) >= least * len(rows)


def test_stages_take_effect(spark):
    """Each stage on what its predecessor kept, against its operator's own report on that input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    columns = docs.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    stages = [f for _, f in corpus_pipeline.STAGES]
    kept = stages[0](spark, docs, SF_DIR).cache()
    assert kept.columns == columns and ids(kept) == ids(quality.scores(docs, labels).where("predicted = 1"))
    alone = stages[1](spark, kept, SF_DIR).cache()
    assert alone.columns == columns
    assert ids(alone) == ids(jaccard.linked_documents(kept).where("component_id = doc_id or n_shingles = 0"))
    clean = stages[2](spark, alone, SF_DIR).cache()
    found = decontaminate.report(decontaminate.occurrences(alone, bench))
    assert clean.columns == columns and ids(clean) == ids(found.where("not contaminated"))
    safe = stages[3](spark, clean, SF_DIR).cache()
    assert safe.columns == columns and ids(safe) == ids(clean)
    assert secrets.report(safe).where("spans <> ''").count() == 0
    mixed = stages[4](spark, safe, SF_DIR)
    assert mixed.columns == [*columns, "mix_rate"] and ids(mixed) == ids(safe)
    assert ids(corpus_pipeline.run(spark, SF_DIR)) == ids(mixed)
    assert ids(mixed.where("mix_rate >= 0")) == ids(mixing.mixed(safe, labels, corpus_pipeline.TARGETS))


def test_stages_on_nothing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0
