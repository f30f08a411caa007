from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from glyphatlas.llm import mixing
from tests.llm.cases import empty, messy, messy_rows, prose


def wanted(sizes):
    """{source: target} by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_ones, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_ones:
        share = left / sum(weight[s] for s in open_ones)
        full = {s for s in open_ones if share * weight[s] >= 2 * sizes[s]}
        if not full:
            return out | {s: share * weight[s] for s in open_ones}
        for s in full:
            out[s] = 2 * sizes[s]
            left -= out[s]
        open_ones -= full
    return out


def many(spark):
    rows = [(i, prose(i, 5 + i % 90), f"s{i % 7 * (i % 3 > 0)}" if i % 11 else None) for i in range(400)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("block", [512, 64])
def test_contract(spark, block):
    rows, docs = many(spark)
    out = mixing.taken(docs, block).collect()
    assert len(out) == len(rows)
    source = {i: s for i, _, s in rows}
    sizes = Counter()
    for i, t, s in rows:
        sizes[s] += len(t.split())
    targets = wanted(sizes)
    took = Counter()
    for r in out:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        took[s] += r["taken"]
    for s in sizes:
        assert abs(took[s] - targets[s]) <= 0.5
    assert sorted(map(tuple, mixing.taken(docs.repartition(5), block).collect())) == sorted(map(tuple, out))


def test_schedule_keeps_to_the_shares_all_along(spark):
    rows = [("a", 60_000, 90_000.0), ("b", 40_000, 30_000.0), (None, 1_000, 2_000.0)]
    slots = mixing.schedule(spark.createDataFrame(rows, "source string, source_size long, target double"), 100).orderBy("slot").collect()
    seen, total = Counter(), sum(r[2] for r in rows)
    ranks = defaultdict(list)
    for n, r in enumerate(slots, 1):
        seen[r["source"]] += 1
        ranks[r["source"]].append(r["rank"])
        if n < len(slots) - 20:
            for s, _, target in rows:
                assert abs(seen[s] - n * target / total) < 6
    for s, _, target in rows:
        assert ranks[s] == list(range(-(-int(target) // 100)))


def test_pieces_tile_each_reading(spark):
    _, docs = many(spark)
    pieces, _, _ = mixing.mix(docs, 64)
    held = defaultdict(list)
    slots = Counter()
    for r in pieces.collect():
        held[r["row"], r["reading"]].append((r["from_word"], r["to_word"]))
        slots[r["slot"]] += r["to_word"] - r["from_word"]
    for spans in held.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert max(slots.values()) == 64 and sum(v < 64 for v in slots.values()) <= 8


def test_awkward_rows(spark):
    out = mixing.taken(messy(spark)).collect()
    assert len(out) == len(messy_rows()) and sum(r["size"] for r in out) == sum(len((x[1] or "").encode().split()) for x in messy_rows())
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    docs = mixing.mixed_documents(messy(spark))
    assert docs.columns == messy(spark).columns and docs.where(F.col("doc_id") == 5).count() == 0


def test_empty_table(spark):
    assert mixing.taken(empty(spark)).count() == 0 and mixing.mixed_documents(empty(spark)).count() == 0
