import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import glyphatlas.operators.retrieval as H
from glyphatlas.functions.vectors import doubles, unit


def lists(x):
    return pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))


def counted(ids, v, pairs, batch):
    g = H._Group()
    src, dst = (pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1))
    g.add(0, pa.table({"id": src, "dst": dst}))
    rows = pa.table({"id": pa.array(ids, pa.int64()), "v": lists(v)})
    for kind in (1, 2):
        for a in range(0, len(v), batch):
            g.add(kind, rows.slice(a, batch))
    return g


@pytest.mark.parametrize("spread", [None, 1e-2, 1e-4, 1e-6])
@pytest.mark.parametrize("sorted_from", [0, 2, 100])
def test_single_precision_counts_as_double_does(monkeypatch, spread, sorted_from):
    monkeypatch.setattr(H, "TILE", 300)
    monkeypatch.setattr(H, "COLUMNS", 64)
    monkeypatch.setattr(H, "SORTED_FROM", sorted_from)
    draw = np.random.default_rng(3)
    q = draw.normal(size=(400, 16))
    if spread is not None:  # as after many rounds of smoothing; the others have no links
        q[:300] = q[0] + spread * q[:300]
    q[20:30] = q[10]  # copies
    q[390] = 0
    q /= np.maximum(np.linalg.norm(q, axis=1), 1e-300)[:, None]
    pairs = [(i, int(j)) for i in range(0, 120, 3) for j in draw.integers(0, 300, 1 + i % 5) if i != j] + [(7, j) for j in range(8, 200)] + [(10, 21), (21, 10)]
    pairs = sorted(set(pairs))
    g = counted(range(400), q, pairs, 150)
    assert len(g.q) == len({s for s, _ in pairs})  # a source is compared once, whatever its pairs
    got = dict(zip(zip(g.src.tolist(), g.dst.tolist(), strict=True), g.above.tolist(), strict=True))
    assert set(got) == set(pairs)
    for s, t in pairs:
        sims = np.round(np.einsum("ij,j->i", q, q[s]), 9)
        target = sims[t]
        sims[s] = -np.inf
        assert got[s, t] == (sims > target).sum()


def test_what_is_not_a_number_is_nearer_than_nothing():
    q = np.random.default_rng(4).normal(size=(60, 4))
    q /= np.linalg.norm(q, axis=1)[:, None]
    q[50:] = np.nan
    g = counted(range(60), q, [(0, 1), (2, 3), (55, 4), (5, 56)], 25)
    for s, t, above in zip(g.src, g.dst, np.where(np.isfinite(g.limit), g.above, 0), strict=True):
        sims = np.round(q @ q[s], 9)
        assert above == sum(sims[i] > sims[t] for i in range(60) if i != s)


def test_pairs_of_a_frequent_source_are_dealt_to_several_groups(spark, monkeypatch):
    monkeypatch.setattr(H, "MOST_PAIRS", 10)
    q = np.random.default_rng(5).normal(size=(80, 4))
    q /= np.linalg.norm(q, axis=1)[:, None]
    df = spark.createDataFrame([(k, i, [float(x) for x in v]) for k in ("x", None) for i, v in enumerate(q)], "k string, id bigint, embedding array<double>")
    pairs = [(0, j) for j in range(1, 80)] + [(j, 0) for j in range(1, 9)]
    got = {(r["k"], r["src"], r["dst"]): r["rank"] for r in H.target_ranks(df, spark.createDataFrame(pairs, "src bigint, dst bigint"), ("k",)).collect()}
    assert len(got) == 2 * len(pairs)
    for (_, s, t), rank in got.items():
        sims = np.round(q @ q[s], 9)
        assert rank == 1 + sum(sims[i] > sims[t] for i in range(80) if i != s)


def test_the_length_of_a_vector_is_worked_out_once(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None])], "id int, v array<float>")
    out = df.select("id", unit(doubles(F.col("v"))).alias("u"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
    assert [r["u"] for r in out.orderBy("id").collect()] == [[0.6, 0.8], [0.0, 0.0], None, [None, None]]
