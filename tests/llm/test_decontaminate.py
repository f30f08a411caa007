import random

import numpy as np

from glyphatlas.llm import decontaminate as dc
from tests.llm.cases import empty, messy, messy_rows, prose, texts


def tiling(a, b, least):
    """Greedy string tiling by trying all pairs of places."""
    marked_a, marked_b, covered = [False] * len(a), [False] * len(b), 0
    while True:
        best, found = least - 1, []
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not marked_a[i + k] and not marked_b[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best >= least:
                    found.append((i, j))
        if best < least:
            return covered
        for i, j in found:
            if not any(marked_a[i:i + best]) and not any(marked_b[j:j + best]):
                marked_a[i:i + best] = marked_b[j:j + best] = [True] * best
                covered += best


def test_tiles_match_brute_force_and_do_not_overlap():
    draw = random.Random(2)
    for _ in range(150):
        a = [draw.randrange(5) + 10 for _ in range(draw.randint(3, 25))]
        b = [draw.randrange(5) + 10 for _ in range(draw.randint(3, 40))]
        tiles = dc.tile(np.array(a, np.uint64), np.array(b, np.uint64), 3)
        assert sum(t[2] for t in tiles) == tiling(a, b, 3)
        for side in (0, 1):
            places = [x for t in tiles for x in range(t[side], t[side] + t[2])]
            assert len(places) == len(set(places))
        assert all(a[i:i + n] == b[j:j + n] for i, j, n in tiles) and [t[2] for t in tiles] == sorted((t[2] for t in tiles), reverse=True)


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_finds_copies_reordered_passages_and_nothing_else(spark, monkeypatch):
    items = [(i, prose(700 + i, 40)) for i in range(8)] + [(20, "four words are few"), (21, None), (24, "Élan où naît l'été à Évian, çà et là"), (22, prose(702, 40)), (23, prose(900, 150))]
    words = [t.split() for _, t in items[:8]]
    shuffled = words[1][20:] + ["between", "them"] + words[1][:20]
    third = words[3][:12]
    docs = [
        (1, prose(1, 50) + " " + items[0][1].upper() + " " + prose(2, 50)), (2, " ".join(prose(3, 20).split() + shuffled)), (3, " ".join(third) + " " + prose(4, 80)),
        (4, prose(5, 100)), (5, items[2][1] + "\n" + prose(6, 10)), (6, items[4][1].replace(" ", ", ")), (7, "four words are few " + prose(7, 30)), (8, " ".join(prose(900, 150).split()[:60])), (9, "ÉLAN OÙ NAÎT L'ÉTÉ À ÉVIAN, ÇÀ ET LÀ!! " + prose(8, 30)),
    ]
    want = {(1, 0), (2, 1), (5, 2), (5, 22), (6, 4), (8, 23), (9, 24)}
    got = dc.leaks(texts(spark, docs), benchmark(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert {r["n_tiles"] for r in got if r["doc_id"] == 2} == {2}
    monkeypatch.setattr(dc, "BLOCK_WORDS", 100)  # several passes over the documents
    again = dc.leaks(texts(spark, docs), benchmark(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in again} == want
    kept = {r["doc_id"] for r in dc.clean(texts(spark, docs), benchmark(spark, items)).collect()}
    assert kept == {3, 4, 7}


def test_awkward_and_empty_tables(spark):
    items = benchmark(spark, [(1, messy_rows()[3][1]), (None, None), (2, "")])
    assert {r["doc_id"] for r in dc.leaks(messy(spark), items).collect()} == {4}
    out = dc.clean(messy(spark), items)
    assert out.columns == messy(spark).columns and out.count() == len(messy_rows()) - 1
    assert dc.leaks(messy(spark), items.where("false")).count() == 0 and dc.leaks(empty(spark), items).count() == 0
