import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from glyphatlas.llm import sharding
from glyphatlas.llm.sharding import Leaf
from tests.llm.cases import empty, messy, messy_rows


def placed(spark, tree, n=3000):
    keys = spark.range(n).select(F.col("id").cast("string").alias("k"))
    return {r["k"]: r["s"] for r in keys.select("k", sharding.shard_of(F.col("k"), tree).alias("s")).collect()}


def test_shares_follow_weights(spark):
    tree = (Leaf("a", "a1", 0, 1.0), Leaf("a", "a1", 1, 3.0), Leaf("b", "b1", 2, 2.0), Leaf("b", "b2", 3, 0.0))
    seen = Counter(placed(spark, tree, 6000).values())
    assert set(seen) == {0, 1, 2}
    for shard, weight in ((0, 1), (1, 3), (2, 2)):
        assert abs(seen[shard] - 1000 * weight) < 150


def test_one_more_shard_takes_rows_only_into_itself(spark):
    before, after = placed(spark, sharding.TREE), placed(spark, sharding.grown(sharding.TREE))
    moved = [k for k in before if before[k] != after[k]]
    assert moved and all(after[k] == 8 for k in moved)
    assert abs(len(moved) - 3000 / 9) < 80


def test_changed_weight_moves_rows_within_its_subtree_only(spark):
    # a shard grows and its neighbour in the rack shrinks by as much: rack and region keep their weights
    changed = tuple(Leaf(x.region, x.rack, x.shard, {2: 1.5, 3: 0.5}.get(x.shard, 1.0)) for x in sharding.TREE)
    before, after = placed(spark, sharding.TREE), placed(spark, changed)
    assert {(before[k], after[k]) for k in before if before[k] != after[k]} == {(3, 2)}
    # a region grows: rows leave the other region only
    heavier = tuple(Leaf(x.region, x.rack, x.shard, 2.0 if x.region == "r1" else 1.0) for x in sharding.TREE)
    after = placed(spark, heavier)
    assert all(before[k] < 4 <= after[k] for k in before if before[k] != after[k])


def test_rows_and_slots(spark):
    out = sharding.place(messy(spark)).collect()
    want = sorted((r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in messy_rows())
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in out) == want
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append((r["slot"], r["doc_id"] is not None, r["doc_id"] or 0))
    for held in slots.values():
        held.sort()
        assert [s for s, *_ in held] == list(range(len(held))) and [h[1:] for h in held] == sorted(h[1:] for h in held)
    assert len({r["shard"] for r in out if r["doc_id"] == 16}) == 1


def test_documents_keep_their_columns(spark):
    docs = messy(spark)
    out = sharding.place_documents(docs)
    assert set(docs.columns) <= set(out.columns) and out.count() == docs.count()


def test_empty_table(spark):
    assert sharding.place(empty(spark)).count() == 0 and sharding.place_documents(empty(spark)).count() == 0


def test_no_python_on_the_main_path(spark, capsys):
    sharding.place(messy(spark)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
