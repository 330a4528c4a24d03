"""What components and the exact join write on the way."""

import os

from pyspark.sql import functions as F

from shelfline.llm import common
from shelfline.llm.jaccard import linked_documents
from shelfline.session import shared_dir


def _written(spark, before):
    folder = f"{shared_dir(spark)}/llm"
    return {name.split("-", 1)[1]: sum(x.startswith("part-") for x in os.listdir(f"{folder}/{name}"))
            for name in set(os.listdir(folder)) - before}


def _before(spark):
    folder = f"{shared_dir(spark)}/llm"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def _spread(spark, run):
    """Many partitions that nothing puts together."""
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_links_that_lead_to_the_smallest_are_done(spark):
    """A star needs no round; chains and cycles end with the round that changes something last."""
    star = spark.createDataFrame([(i, 1 + i % 2) for i in range(3, 40)] + [(4, 4), (None, 1), (5, None)], "a bigint, b bigint")
    before = _before(spark)
    got = {r.id: r.component for r in common.components(star, "star").collect()}
    assert got == {i: 1 if i == 1 or i > 2 and i % 2 == 0 else 2 for i in [1, 2, *range(3, 40)]}
    assert set(_written(spark, before)) == {"star-0"}
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(60, 1), (101, 100), (100, 102)], "a bigint, b bigint")
    got = {r.id: r.component for r in common.components(chain, "chain", rows=62).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100, 102: 100}


def test_small_tables_are_not_written_as_many_files(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(i, text.replace(f"w{i} ", f"x{i} ", 1) if i % 2 else text + f" y{i}") for i in range(1, 40)] + [(50, "other"), (51, None)],
        "doc_id bigint, text string").repartition(8)
    before = _before(spark)
    rows = _spread(spark, lambda: linked_documents(docs).collect())
    assert {r.component_id for r in rows if r.doc_id < 50} == {1}
    files = _written(spark, before)
    assert not any(name.startswith("sets") for name in files)
    assert all(files[name] <= 1 for name in ("near", "pairs", "known", "placed", "members", "matrix", "held", "components-0"))
    assert common.landed(spark.range(10, numPartitions=8), "wide").select(F.input_file_name()).distinct().count() == 8
