"""Whole jobs over files written for these tests."""

import hashlib
import json
import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphatlas.catalog import inputs
from glyphatlas.operators import graph as G
from glyphatlas.operators import inference as I
from glyphatlas.operators.postings import search_postings
from glyphatlas.plans import jobs
from glyphatlas.sources.exports import read_csv
from glyphatlas.sources import snapshots
from glyphatlas.sources.snapshots import manifest, merge_snapshot, publish_snapshot, read_snapshot
from glyphatlas.streaming.ingest import ingest_stream
from glyphatlas.vocab import ENUM_FIELDS


def write(root, n, name, extra=""):
    folder = os.path.join(root, f"A{n // 1000:03d}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"a{n:06d}.seq"), "w") as f:
        f.write(f"%I A{n:06d} #{n} Jan 01 2020 00:00:00\n%N A{n:06d} {name}\n%S A{n:06d} {','.join(map(str, range(9)))}\n{extra}")


def test_incremental_ingest(spark, tmp_path):
    root, table, bad = str(tmp_path / "seq"), str(tmp_path / "records"), str(tmp_path / "bad")
    for n in (1, 2, 1003):
        write(root, n, f"name {n}")
    assert jobs.ingest(spark, root, table, bad).first()["n_rows"] == 3
    names = lambda: {r["id"]: r["name"] for r in read_snapshot(spark, table).collect()}
    assert names() == {"A000001": "name 1", "A000002": "name 2", "A001003": "name 1003"}
    write(root, 2, "a longer name 2")
    os.remove(os.path.join(root, "A001", "a001003.seq"))
    write(root, 4, "name 4")
    with open(os.path.join(root, "A000", "a000001.seq"), "wb") as f:
        f.write(b"%N A000001 \xff\xfe\n")
    jobs.ingest(spark, root, table, bad)
    assert names() == {"A000001": "name 1", "A000002": "a longer name 2", "A000004": "name 4"}
    assert [r["path"] for r in read_snapshot(spark, bad).collect()] == ["A000/a000001.seq"]
    os.remove(os.path.join(root, "A000", "a000004.seq"))
    jobs.ingest(spark, root, table, bad)
    assert set(names()) == {"A000001", "A000002"}
    assert read_snapshot(spark, table).filter("path_rel = 'A000/a000002.seq' and mtime > 1e9 and size > 50").count() == 1


def test_reference_edges_are_cached_per_file(spark, tmp_path):
    root, cache, edges = str(tmp_path / "seq"), str(tmp_path / "cache"), str(tmp_path / "edges")
    write(root, 1, "a", "%Y A000001 Cf. A000002, A000003.\n")
    write(root, 2, "b", "%Y A000002 A000001\n")
    write(root, 3, "c")
    report = jobs.extract_references(spark, root, cache, edges).first()
    assert (report["n_edges"], report["n_nodes"], report["fan_max"]) == (2, 3, 2)
    assert read_snapshot(spark, cache).count() == 3
    write(root, 1, "a", "%Y A000001 Cf. A000009.\n")
    jobs.extract_references(spark, root, cache, edges)
    assert sorted(map(tuple, read_snapshot(spark, edges).collect())) == [("A000001", "A000002"), ("A000001", "A000009")]


def test_stream_merges_new_files_once(spark, tmp_path):
    root, table, ck = str(tmp_path / "seq"), str(tmp_path / "records"), str(tmp_path / "ck")
    write(root, 1, "one")
    ingest_stream(spark, root, table, ck).awaitTermination()
    write(root, 2, "two")
    ingest_stream(spark, root, table, ck).awaitTermination()
    rows = read_snapshot(spark, table)
    assert {r["id"]: r["name"] for r in rows.collect()} == {"A000001": "one", "A000002": "two"}


def test_stream_and_batch_share_keys_and_quarantine(spark, tmp_path):
    root, table, ck = str(tmp_path / "seq"), str(tmp_path / "records"), str(tmp_path / "ck")
    write(root, 1, "one")
    write(root, 2, "two")
    jobs.ingest(spark, root, table)
    write(root, 3, "three")
    with open(os.path.join(root, "A000", "a[4]*.seq"), "w") as f:
        f.write("%I A000004 #4 Jan 01 2020 00:00:00\n%N A000004 four\n")
    with open(os.path.join(root, "A000", "bad.seq"), "wb") as f:
        f.write(b"%N A000009 \xff\xfe\n")
    ingest_stream(spark, root, table, ck).awaitTermination()
    rows = lambda: {r["path_rel"]: r["name"] for r in read_snapshot(spark, table).collect()}
    want = {"A000/a000001.seq": "one", "A000/a000002.seq": "two", "A000/a000003.seq": "three", "A000/a[4]*.seq": "four"}
    assert rows() == want and read_snapshot(spark, table).count() == 4
    aside = lambda place: [r["path"] for r in read_snapshot(spark, place).collect()]
    assert aside(f"{table}._quarantine") == ["A000/bad.seq"]
    write(root, 1, "one again")
    jobs.ingest(spark, root, table)
    assert rows() == want | {"A000/a000001.seq": "one again"}
    assert aside(f"{table}._quarantine") == ["A000/bad.seq"]
    jobs.extract_references(spark, root, str(tmp_path / "cache"), str(tmp_path / "edges"))
    assert aside(f"{tmp_path / 'cache'}._quarantine") == ["A000/bad.seq"]


def test_failed_publish_leaves_the_pointer(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish_snapshot(spark.range(4), path)
    before = manifest(spark, path)
    real = snapshots._verified
    monkeypatch.setattr(snapshots, "_verified", lambda df, place, *rest: (real(df, place, *rest), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        publish_snapshot(spark.range(9), path)
    assert manifest(spark, path) == before and read_snapshot(spark, path).count() == 4


def test_readers_never_fail_while_versions_are_published(spark, tmp_path):
    path, seen, faults = str(tmp_path / "t"), set(), []
    publish_snapshot(spark.range(1), path)
    stop = threading.Event()

    def watch():
        while not stop.is_set():
            try:
                seen.add(read_snapshot(spark, path).count())
            except Exception as e:  # noqa: BLE001
                faults.append(str(e))

    reader = threading.Thread(target=watch)
    reader.start()
    try:
        for n in range(2, 9):
            publish_snapshot(spark.range(n), path)
    finally:
        stop.set()
        reader.join()
    assert not faults and seen <= set(range(1, 9)) and len(seen) > 1


def test_a_change_rewrites_its_bucket_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10_000).selectExpr("concat('f', id) AS path_rel", "id AS v")
    assert merge_snapshot(rows, path, "path_rel") == snapshots.BUCKETS
    before = manifest(spark, path)["parts"]
    assert merge_snapshot(rows.where("v = 77").withColumn("v", F.lit(-1).cast("long")), path, "path_rel") == 1
    after = manifest(spark, path)["parts"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert merge_snapshot(rows.where("false"), path, "path_rel", rows.where("v IN (5, 6)")) <= 2
    assert merge_snapshot(rows.where("false"), path, "path_rel", rows.where("false")) == 0
    got = read_snapshot(spark, path)
    assert got.columns == ["path_rel", "v"] and (got.count(), got.agg(F.sum("v")).first()[0]) == (9_998, sum(range(10_000)) - 77 - 1 - 11)


def test_a_plain_table_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("concat('f', id) AS k", "id AS v").write.parquet(path)
    merge_snapshot(spark.createDataFrame([("f3", 30), ("g", 1)], "k string, v long"), path, "k")
    assert {r["k"]: r["v"] for r in read_snapshot(spark, path).collect()} == {f"f{i}": i for i in range(10)} | {"f3": 30, "g": 1}


def test_ids_of_seven_digits_stay_apart(spark):
    docs = spark.createDataFrame([(1, "%Y A1234567 Cf. A1234568, A000012.")], "i long, text string")
    assert sorted(map(tuple, G.extract_edges(docs, id_pattern=G.WHOLE_ID_PATTERN).collect())) == [("A1234567", "A000012"), ("A1234567", "A1234568")]
    assert sorted(map(tuple, G.extract_edges(docs).collect())) == [("A1234567", "A000012"), ("A1234567", "A123456")]


@pytest.mark.parametrize("most", [100_000, 1])
def test_split_by_longer_and_longer_prefixes(spark, monkeypatch, most):
    monkeypatch.setattr(G, "_MOST_SORTED", most)
    edges = spark.range(500).selectExpr("cast(id as string) AS from_id", "cast(id + 1 as string) AS to_id")
    split = G.split_edges(edges, 0.1).collect()
    digest = lambda r: (hashlib.md5(f"42:{r['from_id']}-{r['to_id']}".encode()).hexdigest())
    assert {r["from_id"] for r in split if r["split"] == "holdout"} == {r["from_id"] for r in sorted(split, key=digest)[:50]}


def test_snapshot_checks_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert publish_snapshot(spark.range(5), path) == 5
    with pytest.raises(RuntimeError):
        publish_snapshot(spark.range(7), path, expected=8)
    assert read_snapshot(spark, path).count() == 5
    assert publish_snapshot(read_snapshot(spark, path).where("id < 3"), path) == 3
    assert sorted(os.listdir(tmp_path)) == ["t"]
    assert any(f.endswith(".zstd.parquet") for _, _, files in os.walk(path) for f in files)


def messy_classifier(rows):
    """Skips the second row, repeats the first, answers for a place that does not exist, and fails on a word."""
    if any("boom" in r["name"] for r in rows):
        raise RuntimeError("no answer")
    items = [{"index": i, "math_domain": "algebra", "sequence_type": "no such", "growth_class": "linear",
              "origin_era": "unknown"} for i in range(len(rows)) if i != 1]
    return [{"index": 0, "math_domain": "geometry"}, *items, {"index": 99, "math_domain": "other"}], 10 * len(rows), len(rows)


def test_classify_lines_up_and_counts_tokens(spark):
    df = spark.range(7).select("id", F.concat(F.lit("n"), "id").alias("name")).coalesce(1)
    rows = I.classify(df, messy_classifier, ("name",), batch_size=3).orderBy("id").collect()
    assert [r["math_domain"] for r in rows] == ["algebra", None, "algebra", "algebra", None, "algebra", "algebra"]
    assert [r["sequence_type"] for r in rows][:2] == ["other", None]
    assert [r["input_tokens"] for r in rows] == [30, 0, 0, 30, 0, 0, 10]


def test_enrich_resumes(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    rows = spark.range(6).select(
        F.concat(F.lit("A"), "id").alias("id"), F.when(F.col("id") == 4, "boom").otherwise(F.concat(F.lit("n"), "id")).alias("name"))
    publish_snapshot(rows.coalesce(1), src)

    def one(batch):
        return messy_classifier(batch) if "boom" in batch[0]["name"] else (
            [{"index": 0, **{f: "other" if f in ("math_domain", "sequence_type") else "unknown" for f in ENUM_FIELDS}}], 1, 1)

    import glyphatlas.plans.jobs as J

    real, seen = J.I.classify, []

    def small(df, classifier, columns, **kw):
        seen.append(df.count())
        return real(df, classifier, columns, batch_size=1)

    J.I.classify = small
    try:
        report = jobs.enrich(spark, src, out, one, columns=("name",), chunks=2).first()
        assert (report["n_complete"], report["n_null"]) == (5, 1) and sum(seen) == 6
        seen.clear()
        report = jobs.enrich(spark, src, out, one, columns=("name",)).first()
        assert sum(seen) == 1 and report["n_failed"] == 1
        errors = [r["error"] for r in spark.read.parquet(f"{out}._answers").where("error IS NOT NULL").collect()]
        assert len(errors) == 2 and all("Error" in e or "Exception" in e for e in errors)
        seen.clear()
        publish_snapshot(rows.withColumn("name", F.when(F.col("id") == "A2", "edited").otherwise(F.col("name"))).coalesce(1), src)
        jobs.enrich(spark, src, out, one, columns=("name",))
        assert sum(seen) == 2  # the edited row and the failing one
        seen.clear()
        jobs.enrich(spark, src, out, one, columns=("name",), version="2")
        assert sum(seen) == 6
    finally:
        J.I.classify = real
    assert jobs.enrich(spark, src, str(tmp_path / "copy"), skip=True).first()["n_rows"] == 6


def toy_embedder(texts):
    return [[float(len(t)), 1.0, float(t.count("a"))] for t in texts]


def test_embed_again_only_what_changed(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "vec")
    base = "'' AS comments, '' AS formulas, '' AS examples, array('tabl', 'easy') AS keywords, '1' AS values_preview_str"
    publish_snapshot(spark.sql(f"SELECT concat('A', id) AS id, concat('name ', id) AS name, {base} FROM range(5)"), src)
    assert jobs.embed_records(spark, src, out, toy_embedder) == 5
    publish_snapshot(spark.sql(f"SELECT concat('A', id) AS id, concat('name ', id, if(id = 2, ' aaaa', '')) AS name, {base} FROM range(1, 6)"), src)
    calls = []
    import glyphatlas.plans.jobs as J

    real = J.I.embed
    J.I.embed = lambda df, *a: (calls.append(df.count()), real(df, *a))[1]
    try:
        assert jobs.embed_records(spark, src, out, toy_embedder) == 5
    finally:
        J.I.embed = real
    assert calls == [2]  # one new id, one edited text
    vec = {r["id"]: r["embedding"] for r in read_snapshot(spark, out).collect()}
    assert set(vec) == {"A1", "A2", "A3", "A4", "A5"} and vec["A2"][2] == vec["A1"][2] + 4


def test_from_records_to_map(spark, sf, tmp_path):
    p = lambda name: str(tmp_path / name)
    publish_snapshot(inputs.records(spark, sf), p("raw"))
    audit = jobs.select_records(spark, p("raw"), p("selected"), "all")
    kept = {r["reason"]: r["n_rows"] for r in audit.collect()}["kept"]
    assert read_snapshot(spark, p("selected")).count() == kept
    scores = [r["select_score"] for r in read_snapshot(spark, p("selected")).select("select_score").collect()]
    assert len(scores) == kept
    assert jobs.enrich(spark, p("selected"), p("enriched")).first()["n_complete"] == kept
    assert jobs.embed_records(spark, p("enriched"), p("vec"), dim=64) == kept
    ids = read_snapshot(spark, p("enriched")).select("id")
    ring = ids.withColumn("k", F.expr("cast(substring(id, 2) as int)"))
    pairs = ring.alias("a").join(ring.selectExpr("id AS other", "k - 1 AS k"), "k").selectExpr("id AS from_id", "other AS to_id")
    more = ring.join(ring.selectExpr("id AS other", "k - 5 AS k"), "k").selectExpr("id AS from_id", "other AS to_id")
    publish_snapshot(pairs.unionByName(more), p("edges"))
    grid = jobs.smooth(spark, p("enriched"), p("vec"), p("edges"), p("smooth"), alphas=(0.4,), n_iters=(1, 2))
    assert grid.count() == 3 and read_snapshot(spark, p("smooth/vectors")).count() == kept
    summary = jobs.place_and_label(spark, p("enriched"), p("smooth/vectors"), p("map"), min_size=5, min_clusters=2)
    assert summary.where(F.col("n_rows") == kept).count() == summary.count() > 0
    config = json.loads(jobs.map_tables(spark, p("enriched"), p("map"), p("tables")).first()["config"])
    points = read_snapshot(spark, p("tables/points"))
    assert config["totalCount"] == points.count() == kept
    assert set(config["ranges"]) == {"edits", "refs", "links", "year"} and config["domains"][-1] == "other"
    jobs.index_map(spark, p("tables"), p("index"))
    one = points.first()
    assert one["id"] in {r["key"] for r in search_postings(spark, p("index"), one["search_text"][:20].upper()).collect()}
    xy = np.array([(r["x"], r["y"]) for r in points.select("x", "y").collect()])
    assert np.isfinite(xy).all()
    sample = jobs.draw_sample(spark, p("raw"), p("samples"), 20, 7)
    assert sample.count() == 20 and os.path.isdir(p("samples/n=20/seed=7"))


def test_annotator_job_writes_csv(spark, sf, tmp_path):
    out = str(tmp_path / "csv")
    a, b = inputs.annotator(spark, sf, "a"), inputs.annotator(spark, sf, "b")
    tables = jobs.compare_annotators(a, b, out)
    cols = tables["disagreements"].columns
    back = read_csv(spark, out, ", ".join(f"`{c}` {'bigint' if c == 'n_disagree' else 'string'}" for c in cols))
    assert sorted(map(str, back.collect())) == sorted(map(str, tables["disagreements"].collect()))
    assert tables["histogram"].agg(F.sum("n_rows")).first()[0] == back.count()
    from glyphatlas.operators.agreement import confusion_wide, join_annotators
    from glyphatlas.vocab import ENUM_DOMAINS

    wide = confusion_wide(join_annotators(a, b), "origin_era", ENUM_DOMAINS["origin_era"])
    assert set(wide.columns) == {"a", *ENUM_DOMAINS["origin_era"], "(null)"}


def test_variants_are_built_once(spark, tmp_path):
    rng = np.random.default_rng(4)
    q = np.concatenate([rng.normal(size=(15, 4)) * 0.1 + 3 * rng.normal(size=4) for _ in range(3)])
    ids = [f"A{i:06d}" for i in range(45)]
    vec = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, q)], "id string, embedding array<double>")
    publish_snapshot(vec, str(tmp_path / "vec"))
    split = spark.createDataFrame([(ids[i], ids[i + 1], "train") for i in range(0, 44, 2)], "from_id string, to_id string, split string")
    publish_snapshot(split, str(tmp_path / "split"))
    records = vec.selectExpr("id", "concat('name of ', id) AS name", "'1' AS values_preview_str", "'some words' AS comments")
    publish_snapshot(records, str(tmp_path / "records"))
    args = (str(tmp_path / "records"), str(tmp_path / "vec"), str(tmp_path / "split"), str(tmp_path / "out"))
    run = lambda: jobs.compare_variants(
        spark, *args, variants=(("plain", 0.0, 0), ("soft", 0.5, 2)), epochs=1, min_size=5, min_clusters=2).collect()
    first = run()
    assert {r["variant"] for r in first} == {"plain", "soft"} and sorted(map(str, run())) == sorted(map(str, first))
