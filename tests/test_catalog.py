"""A few named queries against their SQL answers at the smallest scale; scripts/compare.py runs all of them."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from glyphatlas.catalog import ANSWERS, QUERIES
from scripts.compare import rows_of

WITHOUT_SQL = {
    "hash_embed", "pca_2d", "layout_2d", "layout_recall", "knn_recall", "spanning_forest", "density_layers", "density_layers_vectors"}
SAMPLE = ("tagged_records", "tagged_lines", "changed_files", "scope_curated", "agreement", "edge_split", "adjacency",
          "class_cohesion", "knn_graph", "map_points", "facet_values", "cluster_names")


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


def test_every_query_has_an_answer():
    assert set(QUERIES) - set(ANSWERS) == WITHOUT_SQL
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_answer(spark, sf, con, name):
    df = queries()[name](spark, sf)
    res = con.execute(oracle_sql()[name])
    want = rows_of([c[0] for c in res.description], res.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_results_do_not_depend_on_partitions(spark, sf):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append([sorted(map(str, queries()[q](spark, sf).collect())) for q in ("batch_prompts", "hits_at_k", "signal_auc")])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_entry(spark):
    assert entry(spark).count() > 0


def test_scan_writes_few_folders(spark, tmp_path):
    from glyphatlas.session import run_folder

    ids = [*range(150), 7, 7, -5, 1234567, None, None]
    rows = [(i, f"%I B{i}\r%I B0\nmore {i}" if i != 3 else None, "en", "src1", None if i == 8 else 5) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    place = run_folder(spark).removeprefix("file:")
    before = set(os.listdir(place)) if os.path.isdir(place) else set()
    got = {r["path"]: r for r in queries()["tagged_scan"](spark, str(tmp_path)).collect()}
    new = [d for d in os.listdir(place) if d not in before]
    assert len(new) == 1 and sum(d.startswith("folder=") for d in os.listdir(os.path.join(place, new[0]))) <= 5
    from glyphatlas.catalog import inputs

    texts = {}
    for r in inputs.tagged(spark, str(tmp_path)).collect():
        texts.setdefault(r["path"] or "__HIVE_DEFAULT_PARTITION__", []).append(r["text"] or "")
    assert set(got) == set(texts)
    for path, parts in texts.items():
        assert got[path]["size"] == len("\n".join(parts).encode()) and got[path]["valid"]
