import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphatlas.operators import graph as G
from glyphatlas.operators import smoothing as S
from glyphatlas.operators import vectors as V
from glyphatlas.operators.retrieval import hits_at_k, target_ranks


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, q):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(q)], "id bigint, embedding array<double>")


def matrix(df):
    return {r["id"]: np.array(r["embedding"]) for r in df.collect()}


def edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "from_id bigint, to_id bigint")


def plain_smoothing(q0, links, alpha, n):
    a = np.zeros((len(q0), len(q0)))
    for i, j in links:
        a[i, j] += 1
        a[j, i] += 1
    deg = a.sum(1)
    a = a / np.where(deg == 0, 1, deg)[:, None]
    q = q0.copy()
    for _ in range(n):
        q = np.where((deg > 0)[:, None], (1 - alpha) * q0 + alpha * a @ q, q0)
    return unit(q)


LINKS = [(0, 1), (2, 3), (0, 4), (0, 5), (0, 6)]


@pytest.fixture(scope="module")
def q0():
    return unit(np.random.default_rng(3).normal(size=(10, 16)))


@pytest.mark.parametrize("block_bytes, cell_links", [(S.BLOCK_BYTES, S.CELL_LINKS), (2000, 2)])
def test_smoothing_matches_plain_arithmetic(spark, q0, block_bytes, cell_links):
    out = S.retrofit_variants(frame(spark, q0), G.adjacency(edges(spark, *LINKS)), [0.0, 0.8, 1.0], [1, 4, 5], block_bytes, cell_links)
    rows = out.collect()
    assert len(rows) == 90
    for r in rows:
        want = plain_smoothing(q0, LINKS, r["alpha"], r["n_iter"])[r["id"]]
        assert np.allclose(r["embedding"], want, atol=1e-9)


def test_hubs_over_many_cells_and_named_settings(spark, monkeypatch):
    # two hubs, one of them with fewer than a 500th of the links, in cells of 7 links
    monkeypatch.setattr(S, "_AT_ONCE", 5)
    draw = np.random.default_rng(8)
    q = unit(draw.normal(size=(300, 5)))
    links = sorted({(0, i) for i in range(1, 290)} | {(1, i) for i in range(2, 12)} | {tuple(sorted(map(int, p))) for p in draw.integers(2, 300, (900, 2)) if p[0] != p[1]})
    asked = [(0.3, 2), (0.9, 4), (0.9, 0)]
    out = S.smoothed(frame(spark, q), G.adjacency(edges(spark, *links)), asked, 3000, 7).collect()
    assert len(out) == 3 * 300 and {(r["alpha"], r["n_iter"]) for r in out} == set(asked)
    want = {s: plain_smoothing(q, links, *s) for s in asked}
    for r in out:
        assert np.allclose(r["embedding"], want[r["alpha"], r["n_iter"]][r["id"]], atol=1e-9)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("glyphatlas")]


def test_smoothing_with_text_ids_and_links_to_nowhere(spark):
    vec = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [1.0, 1.0])], "id string, embedding array<double>")
    links = spark.createDataFrame([("a", "b", 1.0), ("b", "x", 1.0), ("x", "a", 1.0)], "src string, dst string, weight double")
    got = {r["id"]: r["embedding"] for r in S.retrofit(vec, links, 0.5, 1).collect()}
    assert np.allclose(got["a"], [0.5**0.5, 0.5**0.5]) and got["b"] == [0.0, 1.0] and np.allclose(got["c"], [0.5**0.5, 0.5**0.5])


def test_smoothing_moves_one_vector_a_node_and_sums_a_block_once(spark):
    draw = np.random.default_rng(12)
    q = unit(draw.normal(size=(600, 5)))
    links = sorted({tuple(sorted(map(int, p))) for p in draw.integers(0, 600, (9000, 2)) if p[0] != p[1]})
    sent = []

    class Seen:
        """Widths of what each round hands on, from the schemas of the written states."""

        def __call__(self, df, replaces=None):
            out = settle(df, replaces=replaces)
            if "block" in out.columns:
                sent.append(max(len(r["q"]) for r in out.select("q").collect()))
            return out

    settle, S.settle = S.settle, Seen()
    try:
        asked = [(a, n) for a in (0.2, 0.5, 0.9, 1.0) for n in (1, 3)]
        got = S.smoothed(frame(spark, q), G.adjacency(edges(spark, *links)), asked).collect()
    finally:
        S.settle = settle
    assert sent == [5] * 4  # one vector a node and round, whatever the number of settings
    want = {s: plain_smoothing(q, links, *s) for s in asked}
    assert len(got) == 600 * 8 and all(np.allclose(r["embedding"], want[r["alpha"], r["n_iter"]][r["id"]], atol=1e-9) for r in got)


def test_ranks_count_repeated_ids_as_joins_do(spark):
    q = unit(np.random.default_rng(15).normal(size=(30, 4)))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(q)] + [(3, [float(x) for x in q[4]]), (None, [float(x) for x in q[5]])]
    df = spark.createDataFrame(rows, "id bigint, embedding array<double>")
    got = {(r["src"], r["dst"]): r["rank"] for r in target_ranks(df, spark.createDataFrame([(3, 9), (9, 3), (2, 7), (None, 7), (2, 99)], "src bigint, dst bigint")).collect()}
    ids, v = np.array([-1 if i is None else i for i, _ in rows]), np.array([x for _, x in rows])
    want = {}
    for s, t in [(3, 9), (9, 3), (2, 7)]:
        sims = lambda i: np.round(v @ v[i], 9)
        want[s, t] = 1 + sum(int(((sims(i) > sims(i)[j]) & (ids != s)).sum()) for i in np.flatnonzero(ids == s) for j in np.flatnonzero(ids == t))
    assert got == want


def test_smoothing_directions(spark):
    q0 = unit(np.random.default_rng(42).normal(size=(10, 16)))
    q = matrix(S.retrofit(frame(spark, q0), G.adjacency(edges(spark, (0, 1), (2, 3))), 0.8, 10))
    assert q[0] @ q[1] > q0[0] @ q0[1] and q[2] @ q[3] > q0[2] @ q0[3]
    for i in range(4, 10):
        assert np.allclose(q[i], q0[i], atol=1e-6)
    assert abs(q[0] @ q[2] - q0[0] @ q0[2]) < 0.1
    assert all(abs(np.linalg.norm(v) - 1) < 1e-9 for v in q.values())


def test_adjacency(spark):
    got = {(r["src"], r["dst"]): r["weight"] for r in G.adjacency(edges(spark, (0, 1), (1, 2), (0, 1))).collect()}
    assert got == {(0, 1): 1.0, (1, 0): 2 / 3, (1, 2): 1 / 3, (2, 1): 1.0}
    assert G.adjacency(edges(spark, (0, 1)).where("false")).count() == 0


def test_ranks_with_ties_copies_and_a_hub(spark):
    q = unit(np.random.default_rng(5).normal(size=(60, 5)))
    q[7] = q[8]
    pairs = [(0, j) for j in range(1, 40)] + [(7, 8), (8, 7), (3, 7), (3, 8)]
    got = {(r["src"], r["dst"]): r["rank"] for r in target_ranks(
        frame(spark, q), spark.createDataFrame(pairs, "src bigint, dst bigint")).collect()}
    for s, t in pairs:
        sims = np.round(q @ q[s], 9)
        sims[s] = -np.inf
        assert got[(s, t)] == 1 + (sims > np.round(q[s] @ q[t], 9)).sum()
    assert got[(7, 8)] == 1 and got[(3, 7)] == got[(3, 8)]


def test_ranks_over_many_blocks(spark, monkeypatch):
    import glyphatlas.operators.retrieval as H

    monkeypatch.setattr(H, "CHUNK_BYTES", 1100)  # three blocks of either side
    q = unit(np.random.default_rng(6).normal(size=(50, 4)))
    pairs = spark.createDataFrame([(i, (i * 7 + 1) % 50) for i in range(50)], "src bigint, dst bigint").where("src <> dst")
    row = hits_at_k(frame(spark, q), pairs, ks=(5,)).first()
    ranks = []
    for s, t in map(tuple, pairs.collect()):
        sims = np.round(q @ q[s], 9)
        sims[s] = -np.inf
        ranks.append(1 + (sims > np.round(q[s] @ q[t], 9)).sum())
    ranks = np.array(ranks)
    assert np.isclose(row["mrr"], (1 / ranks).mean()) and np.isclose(row["hits_at_5"], (ranks <= 5).mean())


def members(spark, classes):
    return spark.createDataFrame([(i, c) for c, ids in classes.items() for i in ids], "id bigint, class string")


def test_cohesion_against_pairs(spark):
    q = unit(np.random.default_rng(7).normal(size=(20, 8)))
    classes = {"a": [0, 1, 2, 3, 4], "b": [3, 4, 5, 6, 7, 8], "one": [9], "all": list(range(20))}
    got = {r["class"]: r for r in V.class_cohesion(frame(spark, q), members(spark, classes)).collect()}
    assert set(got) == {"a", "b"}
    for c in "ab":
        ids = classes[c]
        intra = np.mean([q[i] @ q[j] for i in ids for j in ids if i < j])
        inter = np.mean([q[i] @ q[j] for i in ids for j in range(20) if j not in ids])
        assert np.isclose(got[c]["intra"], intra) and np.isclose(got[c]["inter"], inter)
    total = V.cohesion_summary(V.class_cohesion(frame(spark, q), members(spark, classes))).first()
    assert np.isclose(total["weighted_gap"], (5 * got["a"]["gap"] + 6 * got["b"]["gap"]) / 11)
    assert np.isclose(total["mean_gap"], (got["a"]["gap"] + got["b"]["gap"]) / 2)


def test_cohesion_of_equal_vectors(spark):
    q = np.array([[1, 0, 0], [1, 0, 0], [0, 1, 0], [0, 0, 1]])
    row = V.class_cohesion(frame(spark, q), members(spark, {"a": [0, 1]})).first()
    assert (row["intra"], row["inter"]) == (1.0, 0.0)
    empty = V.cohesion_summary(V.class_cohesion(frame(spark, q), members(spark, {"one": [0]}))).first()
    assert (empty["n_classes"], empty["weighted_gap"]) == (0, 0.0)


def test_grid_and_winner(spark):
    rng = np.random.default_rng(9)
    q = unit(rng.normal(size=(40, 6)))
    pairs = sorted({tuple(sorted(map(int, p))) for p in rng.integers(0, 40, size=(120, 2)) if p[0] != p[1]})
    split = G.split_edges(edges(spark, *pairs))
    assert split.where("split = 'holdout'").count() == max(1, round(0.1 * len(pairs)))
    grid = S.retrofit_grid(frame(spark, q), split, members(spark, {"a": range(10), "b": range(5, 30)}), [0.2, 0.8], [1, 2])
    rows = grid.collect()
    assert len(rows) == 5
    best = max((r for r in rows if r["n_iter"] > 0), key=lambda r: (r["hits_at_10"], -r["alpha"], -r["n_iter"]))
    won = S.winner(grid).first()
    _, classes, counts = S.grid_report(frame(spark, q), split, members(spark, {"a": range(10), "b": range(5, 30)}), [0.2, 0.8], [1, 2])
    by = {(r["alpha"], r["n_iter"], r["class"]): r for r in classes.collect()}
    assert len(by) == 10 and all(np.isclose(r["delta_gap"], r["gap"] - by[0.0, 0, r["class"]]["gap"]) for r in by.values())
    assert counts.first()["n_edges"] == len(pairs) and counts.first()["n_vectors"] == 40
    assert (won["alpha"], won["n_iter"]) == (best["alpha"], best["n_iter"])
    start = next(r for r in rows if r["n_iter"] == 0)
    assert np.isclose(won["delta_mrr"], won["mrr"] - start["mrr"])


def test_classes_and_hits_of_the_grid_alone(spark, monkeypatch):
    rng = np.random.default_rng(10)
    q = unit(rng.normal(size=(40, 6)))
    pairs = sorted({tuple(sorted(map(int, p))) for p in rng.integers(0, 40, size=(120, 2)) if p[0] != p[1]})
    split = G.split_edges(edges(spark, *pairs))
    named = members(spark, {"a": range(10), "b": range(5, 30)})
    grid, classes, counts = S.grid_report(frame(spark, q), split, named, [0.2, 0.8], [1, 2])
    hits, same_counts = S.grid_hits(frame(spark, q), split, [0.2, 0.8], [1, 2])
    assert same_counts.collect() == counts.collect()
    assert np.allclose(sorted(map(tuple, hits.collect())), sorted(map(tuple, grid.where("n_iter > 0").select(hits.columns).collect())))
    want = {(r["alpha"], r["n_iter"], r["class"]): r for r in classes.collect()}
    monkeypatch.setattr(S, "hits_at_k", None)  # classes need no ranks
    got = S.grid_classes(frame(spark, q), split, named, [0.2, 0.8], [1, 2]).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r["alpha"], r["n_iter"], r["class"]]
        assert r["n"] == w["n"] and all(np.isclose(r[c], w[c]) for c in ("intra", "inter", "gap", "delta_gap"))


def test_ranking_holds_few_similarities():
    import tracemalloc

    import pyarrow as pa
    import glyphatlas.operators.retrieval as H

    q = unit(np.random.default_rng(11).normal(size=(20_000, 4)))
    lists = pa.FixedSizeListArray.from_arrays(pa.array(q.ravel()), 4).cast(pa.list_(pa.float64()))
    corpus = pa.table({"id": np.arange(len(q)), "v": lists})
    asked = pa.table({"src": np.arange(1500), "dst": np.arange(1, 1501), "sv": lists[:1500], "target": np.round((q[:1500] * q[1:1501]).sum(axis=1), 9)})
    tracemalloc.start()
    try:
        got = H._count_above(asked, corpus)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    sims = np.round(q @ q[9], 9)
    sims[9] = -np.inf
    assert got.column("above")[9].as_py() == (sims > asked.column("target")[9].as_py()).sum()
    assert peak < 80 << 20


def test_invariants_find_faults(spark):
    bad = frame(spark, np.array([[1.0, 0.0], [float("nan"), 0.0], [2.0, 0.0]]))
    row = V.vector_invariants(bad).first()
    assert (row["n_vectors"], row["n_nan"]) == (3, 1) and row["n_not_unit"] >= 1
    assert V.l2_normalize(frame(spark, np.zeros((1, 3)))).select(F.col("embedding")[0]).first()[0] == 0.0


def test_edges_of_the_report_are_worked_out_once(spark):
    texts = spark.createDataFrame([("%Y A000001 Cf. A000002, A000003.",), ("%Y A000002 Cf. A000003.",)], "text string")
    out = G.edge_report(G.canonical(G.extract_edges(texts)))
    assert "regexp_extract" not in out._jdf.queryExecution().toString()
    assert tuple(out.first()) == (3, 3, 1.5, 1.95, 2)


def test_texts_of_the_term_counts_are_cut_once(spark):
    from glyphatlas.operators.inference import tfidf_terms

    out = tfidf_terms(spark.createDataFrame([(1, "one two two"), (1, "one"), (2, None)], "id bigint, text string"))
    assert "Generate" not in out._jdf.queryExecution().toString()
    assert {(r["id"], r["term"], r["tf"], r["df"]) for r in out.collect()} == {(1, "one", 2, 1), (1, "two", 2, 1)}


def test_line_items_are_spread_by_the_size_of_their_table(spark, tmp_path, monkeypatch):
    import glyphatlas.catalog.inputs as I

    rows = spark.range(3000).selectExpr("id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber")
    rows.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(I, "_SHARE", 100, raising=False)
    monkeypatch.setattr(I, "_SMALL", 1)
    out = I.xref(spark, str(tmp_path))
    assert out.rdd.getNumPartitions() > 3 * spark.sparkContext.defaultParallelism and out.count() == 3000
