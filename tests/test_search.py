import numpy as np
import pytest

from glyphatlas.operators import neighbors as B


def frame(spark, q):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(q)], "id bigint, embedding array<double>")


def lists(df):
    got = {}
    for r in df.orderBy("src", "rank").collect():
        got.setdefault(r["src"], []).append((r["dst"], r["distance"]))
    return got


def held_against_all(got, q, k, metric):
    if metric == "cosine":
        q = q / np.linalg.norm(q, axis=1)[:, None]
    for i in range(len(q)):
        d = np.round(1 - np.einsum("ij,j->i", q, q[i]) if metric == "cosine" else np.sqrt(((q - q[i]) ** 2).sum(1)), 9)
        d[i] = np.inf
        want = np.lexsort((np.arange(len(q)), d))[:k]
        assert np.allclose([x for _, x in got[i]], d[want], atol=2e-9)
        near = np.flatnonzero(d < d[want[-1]] - 2e-9)
        assert set(near) <= {j for j, _ in got[i]} and len(got[i]) == k


@pytest.mark.parametrize("spread", [1.0, 1e-2, 1e-4])
@pytest.mark.parametrize("block_rows", [None, 30])
def test_single_precision_loses_no_neighbour(spark, spread, block_rows):
    draw = np.random.default_rng(8)
    q = draw.normal(size=(500, 24))
    q[:200] = q[0] + spread * q[:200]
    held_against_all(lists(B.knn(frame(spark, q), 7, "cosine", block_rows)), q, 7, "cosine")


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e3])
def test_small_blocks_in_few_dimensions(spark, scale):
    draw = np.random.default_rng(9)
    q = np.concatenate([draw.normal(size=(1500, 2)), draw.normal(size=(300, 2)) * 1e-3 + [1, 1], np.column_stack([np.arange(200) / 10, np.zeros(200)])]) * scale
    held_against_all(lists(B.knn(frame(spark, q), 6, "euclidean")), q, 6, "euclidean")
    assert len(q) > 3 * B.SMALL_BLOCK_ROWS  # more than one cell


def test_layout_recall_searches_the_vectors_once(spark, sf, monkeypatch):
    from glyphatlas.catalog import QUERIES

    asked, knn = [], B.knn
    monkeypatch.setattr(B, "layout_2d", lambda start, graph: start)
    monkeypatch.setattr(B, "knn", lambda vectors, *a, **named: asked.append(named.get("metric", "cosine")) or knn(vectors, *a, **named))
    rows = {r["positions"]: r["recall"] for r in QUERIES["layout_recall"](spark, sf).collect()}
    assert asked == ["cosine", "euclidean", "euclidean"]
    assert set(rows) == {"layout_2d", "pca_2d"} and rows["layout_2d"] == rows["pca_2d"] > 0
