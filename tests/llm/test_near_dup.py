import random
from collections import defaultdict

import pytest

from glyphatlas.llm import near_dup
from tests.llm.cases import empty, messy, messy_rows, prose, texts

_LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_set(text, k):
    w = (text or "").encode().translate(_LOW).split()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent):
    """{doc_id: component} over rows with an id."""
    sets = [(i, shingle_set(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1:]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i in root}


def family(seed, n, changes, size=200):
    """Copies of one text, each with some words of its own, so that many pairs fall short of the threshold."""
    draw, base, out = random.Random(seed), prose(seed, size).split(), []
    for i in range(n):
        words = base[:]
        for _ in range(draw.randint(0, changes)):
            words[draw.randrange(len(words))] = f"own{seed}x{i}x{draw.random()}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("rounds", [1, 0])
def test_components_match_brute_force(spark, monkeypatch, rounds):
    monkeypatch.setattr(near_dup, "DRAWN_ROUNDS", rounds)
    many = [t for seed in range(6) for t in family(seed, 14, 12)] + [prose(50 + i, 60) for i in range(20)] + family(9, 6, 1, 12)
    rows = list(enumerate(many, 1))
    random.Random(3).shuffle(rows)
    got = near_dup.components(texts(spark, rows), 3, 85).collect()
    want = brute(rows, 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingle_set(t, 3)) for i, t in rows}


def test_pipeline_parameters(spark):
    rows = list(enumerate([t for seed in range(4) for t in family(seed, 10, 8)], 1))
    got = {r["doc_id"]: r["component_id"] for r in near_dup.components(texts(spark, rows), 5, 80).collect()}
    assert got == brute(rows, 5, 80)


def test_awkward_rows(spark):
    got = near_dup.components(messy(spark), 3, 85).collect()
    rows = [r[:2] for r in messy_rows()]
    assert len(got) == len(rows)
    by_id = defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add(r["component_id"])
    want = brute(rows, 3, 85)
    for i, found in by_id.items():
        if i is None:
            assert found == {None}
        elif i != 17:  # two texts under one id
            assert found == {want[i]}
    assert all(r["kept"] for r in got if r["doc_id"] is None or r["n_shingles"] == 0)


def test_texts_that_share_an_id_are_compared_each(spark):
    def close(text, n):
        words = text.split()
        return " ".join(words[:n] + ["changed"] + words[n:])

    a, b, c, d = (prose(70 + i, 120 + 10 * i) for i in range(4))
    rows = [(5, a), (5, b), (6, close(a, 40)), (7, close(b, 60)), (8, c), (9, c), (9, d), (11, close(d, 50)), (12, prose(80, 90)), (12, prose(81, 90)), (13, prose(80, 90))]
    got = near_dup.components(texts(spark, rows), 3, 85).collect()
    want = brute(rows, 3, 85)
    assert want == {5: 5, 6: 5, 7: 5, 8: 8, 9: 8, 11: 8, 12: 12, 13: 12}
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == sorted((i, want[i]) for i, _ in rows)
    assert {r["doc_id"] for r in got if r["kept"]} == {5, 8, 12}


def test_one_row_of_each_group_stays_with_its_columns(spark):
    docs = messy(spark)
    out = near_dup.first_of_each(docs)
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert {1, 4, 5, 6, 8, 14} <= set(ids) and not {2, 16} & set(ids)
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None}) and ids.count(None) == 2


def test_empty_table(spark):
    assert near_dup.components(empty(spark), 3, 85).count() == 0


def test_a_family_of_near_misses(spark):
    # texts that each change up to 14 of 150 words of one text: alike, but many fall short of the similarity among each other
    rows = list(enumerate(family(12, 300, 14, 150), 1))
    want = brute(rows, 3, 85)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.components(texts(spark, rows), 3, 85).collect()}
    assert got == want and len(set(want.values())) > 20


def test_left_over_pairs_grow_with_the_rows(spark, monkeypatch):
    made = []
    kept = near_dup.confirmed
    monkeypatch.setattr(near_dup, "confirmed", lambda pairs, *rest: made.append(pairs.count()) or kept(pairs, *rest))
    # near misses: 13 words changed, so that hardly any two reach the similarity
    n, draw, base = 400, random.Random(1), prose(31, 150).split()
    rows = []
    for i in range(n):
        words = base[:]
        for at in draw.sample(range(0, 150, 3), 13):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    near_dup.components(texts(spark, rows), 3, 85).count()
    assert made[-1] < 20 * n and len(made) == near_dup.DRAWN_ROUNDS + 2


def test_no_plan_is_kept_many_times_by_the_driver(spark):
    """The driver keeps all figures of a plan once more whenever a part of it ends, so a long plan costs the square of its length."""
    store = spark._jsparkSession.sharedState().statusStore()

    def known():
        listed = store.executionsList()
        return {listed.apply(i).executionId(): listed.apply(i).metrics().size() for i in range(listed.size())}

    last = max(known(), default=-1)
    rows = list(enumerate([t for seed in range(4) for t in family(seed, 14, 12)], 1))
    near_dup.components(texts(spark, rows), 3, 85).count()
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    sizes = [n for i, n in known().items() if i > last]
    assert max(sizes) < 1600
