import numpy as np
import pytest

from glyphatlas.operators import density as Y
from glyphatlas.operators import neighbors as B
from glyphatlas.operators.components import contract
from glyphatlas.vocab import NOISE


def frame(spark, q):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(q)], "id bigint, embedding array<double>")


def brute(q, k, metric):
    q = np.asarray(q, dtype=float)
    if metric == "cosine":
        n = np.linalg.norm(q, axis=1, keepdims=True)
        u = q / np.where(n == 0, 1, n)
        d = np.round(1 - u @ u.T, 9)
    else:
        d = np.round(np.sqrt(((q[:, None] - q[None]) ** 2).sum(-1)), 9)
    out = {}
    for i in range(len(q)):
        order = sorted((d[i, j], j) for j in range(len(q)) if j != i)[:k]
        out[i] = [(j, x) for x, j in order]
    return out


def lists(df):
    got = {}
    for r in df.orderBy("src", "rank").collect():
        got.setdefault(r["src"], []).append((r["dst"], r["distance"]))
    return got


def check(spark, q, k, metric, block_rows):
    got, want = lists(B.knn(frame(spark, q), k, metric, block_rows)), brute(q, k, metric)
    assert set(got) == set(want)
    for i in want:
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]], i
        assert np.allclose([x for _, x in got[i]], [x for _, x in want[i]], atol=2e-9)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("block_rows", [4096, 20])
def test_knn_is_exact(spark, metric, block_rows):
    rng = np.random.default_rng(11)
    q = np.concatenate([rng.normal(size=(60, 4)), rng.normal(size=(60, 4)) * 0.05 + [4, 0, 0, 0]])
    check(spark, q, 6, metric, block_rows)


def test_pivots_in_parts(spark, monkeypatch):
    monkeypatch.setattr(B, "PIVOT_CELLS", 70)  # eleven rows at a time
    check(spark, np.random.default_rng(12).normal(size=(120, 4)), 6, "cosine", 20)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_knn_when_a_third_are_copies(spark, metric):
    rng = np.random.default_rng(12)
    q = np.round(rng.normal(size=(90, 3)), 1)
    q[10:40] = [0.5, -0.25, 1.0]
    q[80] = q[81] = 0.0
    check(spark, q, 5, metric, 16)


def test_knn_on_few_rows(spark):
    assert lists(B.knn(frame(spark, np.eye(3)), 15)) == {0: [(1, 1.0), (2, 1.0)], 1: [(0, 1.0), (2, 1.0)], 2: [(0, 1.0), (1, 1.0)]}
    assert B.knn(frame(spark, np.eye(3)).where("false")).count() == 0


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_approximate_lists_hold_nearly_all_neighbours(spark, metric):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(60, 24)) * 4
    q = np.concatenate([centres[i % 60] + draw.normal(size=24) for i in range(3000)]).reshape(-1, 24)
    q[2900:] = q[:100]  # copies
    df = frame(spark, q)
    got, want = lists(B.knn_approximate(df, 10, metric, leaf_rows=256)), lists(B.knn(df, 10, metric))
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    assert all(len(x) == 10 for x in got.values())


@pytest.mark.parametrize("leaf_rows, tables", [(32, 2), (128, 3)])
def test_descent_finds_them_where_the_cuts_part_them(spark, leaf_rows, tables):
    # wide clusters and few tables: the leaves alone find far too few
    draw = np.random.default_rng(5)
    q = np.repeat(draw.normal(size=(60, 32)), 50, axis=0) + draw.normal(size=(3000, 32)) * 0.7
    df = frame(spark, q)
    near, how = B.knn_counted(df, 10, leaf_rows=leaf_rows, tables=tables)
    got, want = lists(near), lists(B.knn(df, 10))
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want if i % 50 == 0)
    assert hits / sum(len(want[i]) for i in want if i % 50 == 0) >= 0.95
    assert all(len(x) == 10 for x in got.values())
    assert how["cuts"] >= 4 and how["per_row"] < 2 * 20 * 40 * how["rounds"] + tables * 2 * leaf_rows


def test_a_row_that_is_near_to_all_others(spark):
    draw = np.random.default_rng(7)
    q = draw.normal(size=(600, 20))
    q[0] = q.mean(axis=0) * 0.01
    df = frame(spark, q)
    got, want = lists(B.knn_approximate(df, 5, "euclidean", leaf_rows=40)), lists(B.knn(df, 5, "euclidean"))
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want)
    assert hits / sum(map(len, want.values())) >= 0.95


def test_approximate_lists_of_few_rows(spark):
    assert B.knn_approximate(frame(spark, np.zeros((0, 3))), 3).count() == 0
    q = np.random.default_rng(1).normal(size=(40, 5))
    assert lists(B.knn_approximate(frame(spark, q), 5)) == lists(B.knn(frame(spark, q), 5))


def test_exact_search_sends_rows_to_few_groups_and_runs_once(spark):
    q = np.random.default_rng(31).normal(size=(300, 24))  # no cell is out of reach
    near = B.knn(frame(spark, q), 4, block_rows=10)
    unit = q / np.linalg.norm(q, axis=1)[:, None]
    d = np.round(1 - unit @ unit.T, 9)
    np.fill_diagonal(d, np.inf)
    assert lists(near) == {i: [(int(j), float(d[i, j])) for j in np.lexsort((np.arange(300), d[i]))[:4]] for i in range(300)}
    assert "CoGroup" not in near._jdf.queryExecution().toString()  # the lists are read, not worked out again
    assert [B._groups(n, 4096) for n in (1, 10_000, 100_000, 500_000, 1_000_000)] == [1, 8, 8, 8, 16]


def test_memberships_sum_to_the_target(spark):
    q = np.random.default_rng(13).normal(size=(50, 6))
    near = B.knn(frame(spark, q), 8)
    sums = B.memberships(near).groupBy("src").sum("weight").collect()
    assert all(abs(r[1] - 3.0) < 1e-6 for r in sums)
    for r in B.fuzzy_graph(near).collect():
        assert r["a"] < r["b"] and 0 < r["weight"] <= 1 + 1e-12


def estimate(df):
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())


def test_estimates_do_not_grow_along_a_chain(spark):
    n = 100_000
    chain = spark.range(n - 1).selectExpr("id AS a", "id + 1 AS b")
    roots = contract(chain)
    assert estimate(roots) < 1 << 63
    assert roots.where("root = 0").count() == n


def test_layout_with_its_own_epochs(spark):
    q = np.random.default_rng(21).normal(size=(60, 6))
    df = frame(spark, q)
    out = B.layout_2d(B.pca_2d(df), B.fuzzy_graph(B.knn(df, 8)))
    assert estimate(out) < 1 << 63
    assert out.count() == 60


def test_components(spark):
    rng = np.random.default_rng(14)
    pairs = [tuple(map(int, rng.integers(0, 300, 2))) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)]
    parent = list(range(400))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in contract(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}


def test_density_layers_find_blobs(spark):
    rng = np.random.default_rng(15)
    centres = np.array([[0, 0], [10, 0], [0, 10], [10, 10], [20, 20]])
    q = np.concatenate([c + rng.normal(size=(30, 2)) * 0.3 for c in centres] + [rng.uniform(-30, 50, size=(8, 2))])
    near = B.knn(frame(spark, q), 8, "euclidean")
    layers = Y.density_layers(near, min_size=12)
    rows = layers.collect()
    assert len({(r["id"], r["layer"]) for r in rows}) == len(rows)
    coarse = {r["id"]: r["cluster_id"] for r in rows if r["layer"] == 0}
    assert len(coarse) == len(q)
    found = {coarse[i] for i in range(150)} - {NOISE}
    assert len(found) >= 4
    for b in range(5):
        own = {coarse[i] for i in range(30 * b, 30 * b + 30)} - {NOISE}
        assert len(own) == 1
    # finer layers nest in coarser ones
    for r in Y.cluster_tree(layers).collect():
        finer = {x["id"] for x in rows if x["layer"] == r["layer"] and x["cluster_id"] == r["cluster_id"]}
        coarser = {x["id"] for x in rows if x["layer"] == r["layer"] - 1 and x["cluster_id"] == r["parent_id"]}
        assert finer <= coarser


def recall(coords, want, k):
    got = brute(coords, k, "euclidean")
    return np.mean([len({j for j, _ in got[i]} & {j for j, _ in want[i]}) / k for i in want])


def test_layout_keeps_more_neighbours_than_the_main_axes(spark):
    rng = np.random.default_rng(16)
    q = np.concatenate([rng.normal(size=(25, 8)) * 0.3 + 3 * rng.normal(size=8) for _ in range(6)])
    df = frame(spark, q)
    near = B.knn(df, 10)
    start = B.pca_2d(df)
    end = B.layout_2d(start, B.fuzzy_graph(near), epochs=15)
    want = brute(q, 10, "cosine")
    place = lambda d: np.array([(r["x"], r["y"]) for r in d.orderBy("id").collect()])
    a, b = place(start), place(end)
    assert np.isfinite(b).all() and len(b) == len(q)
    assert recall(b, want, 10) >= recall(a, want, 10)


def test_curve_parameters():
    a, b = B.curve_parameters(0.1)
    assert abs(a - 1.577) < 0.01 and abs(b - 0.895) < 0.01
