import pytest
from pyspark.sql import functions as F

from glyphatlas.operators import selection as L
from glyphatlas.operators.ranking import exact_quantiles, grouped_quantiles, nth_key, running_totals, top_rows, with_position

ROW = dict(name="n", comments="", formulas="", examples="", code_languages=[], n_references=0, n_terms_visible=9, edit_count=0)
DDL = ("id string, name string, comments string, formulas string, examples string, code_languages array<string>, "
       "n_references bigint, n_terms_visible bigint, edit_count bigint, keywords array<string>")


def frame(spark, *rows):
    return spark.createDataFrame([{**ROW, **r} for r in rows], DDL)


def pool(spark):
    return frame(spark, *[dict(id=f"A{i}", edit_count=i, keywords=["core"] if i == 0 else ["nice"] if i == 1 else ["nonn"]) for i in range(8)],
                 dict(id="X1", keywords=["dead", "core"], edit_count=99), dict(id="X2", keywords=[], n_terms_visible=7),
                 dict(id="X3", keywords=[], name=""), dict(id="X4", keywords=["dumb"], name=""))


def test_exclusion(spark):
    assert {r["id"] for r in L.hard_exclude(pool(spark)).collect()} == {f"A{i}" for i in range(8)}
    audit = {r["reason"]: r["n_rows"] for r in L.exclude_audit(pool(spark)).collect()}
    assert audit == {"keyword=dead": 1, "keyword=dupe": 0, "keyword=uned": 0, "keyword=dumb": 1, "n_terms<8": 1,
                     "empty name": 2, "any reason": 4, "kept": 8}


@pytest.mark.parametrize("target,want", [(4, {"A0", "A1", "A7", "A6"}), (2, {"A0", "A1"}), (1, {"A1"}), (99, {f"A{i}" for i in range(8)})])
def test_curated(spark, target, want):
    assert {r["id"] for r in L.select(pool(spark), "curated", target).collect()} == want


def test_curated_with_ties_beyond_the_room(spark, monkeypatch):
    """A score that most rows share: the last place is found by refined counts down to the ids."""
    import glyphatlas.operators.ranking as K

    rows = frame(spark, *[dict(id=f"A{i:03d}é{i % 7}", edit_count=5 if i % 4 else i, keywords=["core"] if i % 3 == 0 else ["nonn"]) for i in range(300)],
                 dict(id=None, keywords=["nonn"], edit_count=5))
    scored = rows.withColumn("s", F.round(L.quality_score(), 9)).withColumn("seed", F.array_contains("keywords", "core"))
    want = [r["id"] for r in scored.orderBy(F.desc("seed"), F.desc("s"), "id").collect()]
    monkeypatch.setattr(K.nth_key, "__defaults__", (5,))
    for target in (1, 60, 100, 101, 180, 300, 301):
        got = [r["id"] for r in L.select(rows, "curated", target).select("id").collect()]
        assert sorted(map(str, got)) == sorted(map(str, want[:target]))
    assert L.select(rows, "curated", 0).count() == 0


def test_nth_key(spark):
    df = spark.createDataFrame([("1ABCD01",)] * 50 + [("1ABCD02",), ("2",), (None,)], "k string")
    assert [nth_key(df, n, 3) for n in (0, 1, 50, 51, 52, 53)] == [None, "1ABCD01", "1ABCD01", "1ABCD02", "2", None]
    assert nth_key(df.limit(0), 1) is None


def test_scopes(spark):
    assert [r["id"] for r in L.select(pool(spark), "core").collect()] == ["A0"]
    assert L.select(pool(spark), "all").count() == 8
    with pytest.raises(ValueError):
        L.select(pool(spark), "some")


def test_sample_is_reproducible_and_checked(spark):
    rows = pool(spark)
    first = {r["id"] for r in L.sample_n(rows, 3, 42).collect()}
    assert first == {r["id"] for r in L.sample_n(rows.repartition(7), 3, 42).collect()} and len(first) == 3
    assert first != {r["id"] for r in L.sample_n(rows, 3, 43).collect()} or first != {r["id"] for r in L.sample_n(rows, 3, 44).collect()}
    with pytest.raises(ValueError):
        L.sample_n(rows, 9, 42)


def test_positions_with_one_hot_value(spark):
    df = spark.range(1000).withColumn("v", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 10))
    want = [r["id"] for r in df.orderBy("v", "id").collect()]
    got = {r["position"]: r["id"] for r in with_position(df, [F.col("v"), F.col("id")]).collect()}
    assert [got[i] for i in range(1000)] == want
    sums = running_totals(df, [F.col("v").desc(), F.col("id")], {"t": F.col("v")}).orderBy(F.col("v").desc(), "id").collect()
    total = 0
    for r in sums:
        assert r["t"] == total
        total += r["v"]


def test_quantiles(spark):
    import numpy as np

    xs = [0, 0, 0, 1, 2, 3, 3, 10, 50]
    df = spark.createDataFrame([("a", x) for x in xs] + [("b", 7)], "g string, x bigint")
    row = exact_quantiles(df.where("g = 'a'"), "x", {"m": 0.5, "p": 0.95}).first()
    assert np.allclose([row["m"], row["p"]], np.quantile(xs, [0.5, 0.95]))
    got = {r["g"]: r["q"] for r in grouped_quantiles(df, ["g"], "x", {"q": 0.99}).collect()}
    assert got["b"] == 7 and np.isclose(got["a"], np.quantile(xs, 0.99))


def test_top_rows_beyond_the_driver_limit(spark, monkeypatch):
    import glyphatlas.operators.ranking as K

    monkeypatch.setattr(K, "DRIVER_LIMIT", 10)
    got = top_rows(spark.range(500), 37, [F.col("id").desc()])
    assert sorted(r["id"] for r in got.collect()) == list(range(463, 500))


def test_auc(spark):
    rows = [(1, 3.0, 1.0), (1, 2.0, 1.0), (0, 2.0, 1.0), (0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "y int, s double, flat double")
    got = {r["signal"]: r["auc"] for r in L.signal_auc(df, ["s", "flat"], "y").collect()}
    assert got == {"s": 0.875, "flat": 0.5}
