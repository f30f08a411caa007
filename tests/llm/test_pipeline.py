import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from glyphatlas.llm import queries
from tests.llm.cases import empty, messy, messy_rows, prose


def write(spark, folder, docs, benchmark, labels):
    docs.write.parquet(os.path.join(folder, "documents.parquet"))
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(os.path.join(folder, "benchmark.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(folder, "labels.parquet"))
    return str(folder)


def test_each_stage_drops_what_it_should_and_keeps_the_rest(spark, tmp_path):
    rows, labels = [], []
    for i in range(300):
        toxic = i % 10 == 0
        words = prose(i, 80).split()
        if toxic:
            for at, term in ((5, "vilename"), (40, "nastyword"), (60, "vilename")):
                words.insert(at, term)
        rows.append((i, " ".join(words), f"s{i % 4}"))
        labels.append((i, 1, int(toxic)))
    copies = [(1000, rows[1][1], "s1"), (1001, rows[1][1] + " tail", "s2")]
    leaks = [(1002, prose(5000, 30) + " " + prose(6000, 40) + " " + prose(5001, 30), "s3")]
    docs = spark.createDataFrame(rows + copies + leaks, "doc_id long, text string, source string").withColumn("extra", F.lit(7))
    sf = write(spark, tmp_path, docs, [(1, prose(6000, 40))], labels)
    seen = {}
    at = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, sf)
        out.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r["doc_id"] for r in at.collect()}
        if name != "sharding":
            assert at.columns == docs.columns
    clean = {i for i in range(300) if i % 10}
    assert seen["toxicity"] == clean | {1000, 1001, 1002}
    assert seen["near_duplicates"] == clean | {1002}
    assert seen["decontamination"] == clean
    assert seen["mixing"] <= clean and len(seen["mixing"]) > 200
    assert seen["sharding"] == seen["mixing"] and {"shard", "slot", "text"} <= set(at.columns)


@pytest.mark.parametrize("make", [messy, empty])
def test_awkward_and_empty_tables(spark, tmp_path, make):
    sf = write(spark, tmp_path, make(spark), [(1, messy_rows()[3][1])], [(1, 1, 0), (None, None, None)])
    out = corpus_pipeline.run(spark, sf)
    ids = {r["doc_id"] for r in out.collect()}
    assert ids <= {r[0] for r in messy_rows()} and not ids & {2, 4, 16}


def test_queries_are_named_by_number():
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_a_rejected_row_takes_no_other_with_it(spark, tmp_path):
    rows, labels = [], []
    for i in range(200):
        words = prose(i, 60).split()
        if i % 10 == 0:
            for at, term in ((5, "vilename"), (30, "nastyword"), (40, "vilename")):
                words.insert(at, term)
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, int(i % 10 == 0)))
    vile, leak = rows[0][1] + " more", prose(5000, 30) + " " + prose(6000, 60)
    odd = [(None, vile, "s"), (None, prose(7000, 60), "s"), (None, leak, "s"), (5000, vile, "s"), (5000, prose(7001, 60), "s"), (None, None, "s"), (None, "", "s")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, source string")
    sf = write(spark, tmp_path, docs, [(1, prose(6000, 60))], labels)
    stages = dict(corpus_pipeline.STAGES)
    left = stages["toxicity"](spark, docs, sf)
    assert {(r["doc_id"], r["text"]) for r in left.collect()} == {(i, t) for i, t, _ in rows + odd if "vilename" not in (t or "")}
    left = stages["decontamination"](spark, left, sf)
    want = {(i, t) for i, t, _ in rows + odd if "vilename" not in (t or "") and t != leak}
    assert {(r["doc_id"], r["text"]) for r in left.collect()} == want
