import numpy as np
import pytest

from glyphatlas.operators import hierarchy as H
from glyphatlas.operators import neighbors as B
from glyphatlas.operators.components import relabel
from glyphatlas.operators.density import mutual_reachability
from glyphatlas.session import settle
from glyphatlas.vocab import NOISE
from tests.test_neighbors import frame


def kruskal(edges):
    parent, chosen = {}, []

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for w, a, b in sorted((w, a, b) for a, b, w in edges):
        x, y = find(a), find(b)
        if x != y:
            parent[x] = y
            chosen.append((a, b, w))
    return chosen


def random_edges(seed, n, m, ties):
    draw = np.random.default_rng(seed)
    pairs = {(int(min(p)), int(max(p))) for p in draw.integers(0, n, (m, 2)) if p[0] != p[1]}
    return [(a, b, float(draw.integers(0, 5)) if ties else float(draw.random())) for a, b in sorted(pairs)]


def test_forest_is_the_minimum_one(spark):
    edges = random_edges(1, 200, 300, True)
    got = H.spanning_forest(spark.createDataFrame(edges, "a bigint, b bigint, weight double")).collect()
    assert sorted(tuple(r) for r in got) == sorted(kruskal(edges))


def test_forest_weight_over_neighbours(spark):
    q = np.random.default_rng(2).normal(size=(120, 3))
    edges = mutual_reachability(B.knn(frame(spark, q), 8, "euclidean"))
    got = H.spanning_forest(edges).groupBy().sum("weight").first()[0]
    assert got == pytest.approx(sum(w for _, _, w in kruskal([tuple(r) for r in edges.collect()])))


@pytest.mark.parametrize("block", [H.BLOCK, 40])
def test_forest_in_rounds_and_in_one_task(spark, monkeypatch, block):
    edges = random_edges(4, 200, 400, True)
    rounds = []
    monkeypatch.setattr(H, "relabel", lambda *x: rounds.append(1) or relabel(*x))
    got = H.spanning_forest(spark.createDataFrame(edges, "a bigint, b bigint, weight double"), block).collect()
    assert sorted(tuple(r) for r in got) == sorted(kruskal(edges))
    assert bool(rounds) == (block == 40)


CARRIED = {
    "seen": lambda op, own, up: op.coalesce(own["seen"], up["seen"]),
    "hit": lambda op, own, up: op.either(own["hit"], up["hit"]),
    "most": lambda op, own, up: op.greatest(own["most"], op.plus(own["more"], up["most"])),
    "more": lambda op, own, up: op.plus(own["more"], up["more"])}


@pytest.mark.parametrize("kind", ["chain", "down", "any"])
@pytest.mark.parametrize("block, most", [(H.BLOCK, 2), (90, 9)])
def test_chains_are_followed_in_few_rounds(spark, monkeypatch, kind, block, most):
    n, draw = 1200, np.random.default_rng(6)
    name = draw.permutation(n) if kind == "any" else np.arange(n) if kind == "chain" else np.arange(n)[::-1]
    up = [i + 1 if kind != "any" else int(draw.integers(i + 1, n)) for i in range(n - 1)] + [n - 1]
    own = [(float(i) if i % 50 == 0 and i < n - 1 else None, i % 333 == 0 and i < n - 1, float(i % 7) if i < n - 1 else float("-inf"), 1.0 if i < n - 1 else 0.0) for i in range(n)]
    rows = [(int(name[i]), int(name[up[i]]), *own[i]) for i in range(n)]
    written = []
    monkeypatch.setattr(H, "settle", lambda *a, **b: written.append(1) or settle(*a, **b))
    got = H.followed(spark.createDataFrame(rows, "node bigint, parent bigint, seen double, hit boolean, most double, more double"), CARRIED, block).collect()
    held = {}
    for i in reversed(range(n)):
        seen, hit, best, more = own[i]
        if up[i] != i:
            s, h, b, m = held[name[up[i]]]
            seen, hit, best, more = s if seen is None else seen, hit or h, max(best, more + b), more + m
        held[name[i]] = seen, hit, best, more
    assert {r["node"]: (r["seen"], r["hit"], r["most"], r["more"]) for r in got} == held
    assert {r["root"] for r in got} == {name[-1]} and len(got) == n
    assert len(written) <= most or kind == "any" and block == 90


def sizes(rows, n):
    """Size and lesser side of every merge, by name."""
    return {n + r["merge"]: (r["left_size"] + r["right_size"], r["left"], r["right"]) for r in rows}


@pytest.mark.parametrize("block", [H.BLOCK, 30])
def test_halved_trees_fit_together(spark, block):
    edges = random_edges(3, 150, 200, True)
    forest = spark.createDataFrame(kruskal(edges), "a bigint, b bigint, weight double")
    merges, points, n = H.merge_tree(forest, block)
    rows = sorted(merges.collect(), key=lambda r: r["merge"])
    name = {r["id"]: r["node"] for r in points.collect()}
    held = {v: (v, 1) for v in name.values()}  # point -> (name of its component, size)
    for r, (a, b, w) in zip(rows, sorted(kruskal(edges), key=lambda e: (e[2], e[0], e[1])), strict=True):
        x, y = held[name[a]], held[name[b]]
        assert r["weight"] == w
        assert {(r["left"], r["left_size"]), (r["right"], r["right_size"])} == {x, y}
        whole = (n + r["merge"], x[1] + y[1])
        held = {p: whole if c in (x, y) else c for p, c in held.items()}


def condensed(edges, min_size):
    """{cluster: (parent, birth, size, stability)}, {point: (cluster, density)} by recursion from the top."""
    forest = kruskal(edges)
    order = {e: i for i, e in enumerate(sorted(forest, key=lambda e: (e[2], e[0], e[1])))}
    points = sorted({x for a, b, _ in forest for x in (a, b)})
    clusters, members = {}, {}

    def parts(nodes, tree):
        top = max(tree, key=order.get)
        rest = [e for e in tree if e != top]
        near = {x: [] for x in nodes}
        for e in rest:
            near[e[0]].append(e)
            near[e[1]].append(e)
        side, todo = {top[0]}, [top[0]]
        while todo:
            for a, b, _ in near[todo.pop()]:
                for x in (a, b):
                    if x not in side:
                        side.add(x)
                        todo.append(x)
        return top, (side, [e for e in rest if e[0] in side]), (set(nodes) - side, [e for e in rest if e[0] not in side])

    def walk(nodes, tree, cluster):
        while True:
            if not tree:  # a single point is a cluster only if min_size is 1
                return
            top, one, two = parts(nodes, tree)
            density = 1 / max(top[2], H.NEAREST)
            large = [p for p in (one, two) if len(p[0]) >= min_size]
            if len(large) == 2:
                for p in large:
                    own = len(points) + max(order[e] for e in p[1])
                    clusters[own] = [cluster, density, len(p[0]), 0.0]
                    clusters[cluster][3] += (density - clusters[cluster][1]) * len(p[0])
                    walk(*p, own)
                return
            for p in (one, two):
                if p not in large:
                    for x in p[0]:
                        members[x] = (cluster, density)
                        clusters[cluster][3] += density - clusters[cluster][1]
            if not large:
                return
            nodes, tree = large[0]

    left = set(points)
    while left:
        side, todo = set(), [min(left)]
        while todo:
            x = todo.pop()
            if x not in side:
                side.add(x)
                todo += [y for a, b, _ in forest for y in (a, b) if x in (a, b)]
        tree = [e for e in forest if e[0] in side]
        if len(side) >= min_size:
            own = len(points) + max(order[e] for e in tree)
            clusters[own] = [None, 0.0, len(side), 0.0]
            walk(side, tree, own)
        left -= side
    return clusters, members


def chosen(clusters):
    below = lambda c: [k for k, v in clusters.items() if v[0] == c]

    def best(c):
        parts = [best(k) for k in below(c)]
        rest, names = sum(p[0] for p in parts), set().union(*(p[1] for p in parts)) if parts else set()
        return (clusters[c][3], {c}) if clusters[c][3] >= max(rest, 0) else (rest, names)

    return set().union(*(best(c)[1] for c in clusters if clusters[c][0] is None))


@pytest.mark.parametrize("seed, min_size", [(5, 4)])
def test_condensed_tree_and_its_stable_clusters(spark, seed, min_size):
    draw = np.random.default_rng(seed)
    q = np.concatenate([c + draw.normal(size=(25, 2)) * s for c, s in (((0, 0), 0.3), ((4, 0), 0.5), ((4, 1.5), 0.2), ((-5, 5), 1.0))])
    edges = mutual_reachability(B.knn(frame(spark, q), 6, "euclidean"))
    clusters, members = H.condense(*H.merge_tree(H.spanning_forest(edges)), min_size)
    want, where = condensed([tuple(r) for r in edges.collect()], min_size)
    got = {r["cluster"]: (r["parent"], r["birth"], r["size"], r["stability"]) for r in clusters.collect()}
    assert set(got) == set(want)
    for c, (parent, birth, size, stability) in want.items():
        assert got[c][0] == parent and got[c][2] == size
        assert got[c][1] == pytest.approx(birth) and got[c][3] == pytest.approx(stability)
    assert {r["id"]: (r["cluster"], pytest.approx(r["density"])) for r in members.collect()} == where
    assert {r["cluster"] for r in H.stable_clusters(clusters).collect()} == chosen(want)


def test_best_sums_along_a_chain_and_a_bush(spark):
    draw = np.random.default_rng(8)
    tree = [(i, i - 1 if i else None, float(draw.random())) for i in range(60)]  # a chain
    tree += [(100 + i, int(draw.integers(0, 60)), float(draw.random() * 2)) for i in range(50)]
    tree += [(200 + i, 100 + int(draw.integers(0, 50)), float(draw.random())) for i in range(40)]
    want = {c: [p, 0.0, 1, s] for c, p, s in tree}
    got = H.stable_clusters(spark.createDataFrame(tree, "cluster bigint, parent bigint, stability double"))
    assert {r["cluster"] for r in got.collect()} == chosen(want)


def test_layers_find_blobs_and_nest(spark):
    draw = np.random.default_rng(15)
    centres = [(0, 0), (3, 0), (0, 3), (20, 20), (23, 20), (20, 23), (40, 0), (43, 0)]
    q = np.concatenate([np.array(c) + draw.normal(size=(30, 2)) * 0.3 for c in centres] + [draw.uniform(-60, 90, size=(12, 2))])
    layers = H.stable_layers(B.knn(frame(spark, q), 12, "euclidean"), min_size=20, min_clusters=2).collect()
    by = {}
    for r in layers:
        by.setdefault(r["layer"], {})[r["id"]] = r["cluster_id"]
    assert all(len(v) == len(q) for v in by.values())
    finest = by[max(by)]
    for b in range(8):
        own = [finest[i] for i in range(30 * b, 30 * b + 30)]
        assert max(own.count(c) for c in set(own) - {NOISE}) >= 25
    assert len(set(finest.values()) - {NOISE}) == 8
    share = sum(c == NOISE for c in finest.values()) / len(q)
    assert 12 / len(q) * 0.5 <= share < 0.15
    assert sum(finest[i] == NOISE for i in range(240, 252)) >= 8
    for layer in range(1, len(by)):
        over = {}
        for i, c in by[layer].items():
            if c != NOISE:
                over.setdefault(c, set()).add(by[layer - 1][i])
        assert all(len(v) == 1 for v in over.values())


def test_few_points(spark):
    near = B.knn(frame(spark, np.random.default_rng(1).normal(size=(6, 2))), 3, "euclidean")
    assert {(r["layer"], r["cluster_id"]) for r in H.stable_layers(near).collect()} == {(0, NOISE)}
    assert H.stable_layers(near.where("false")).count() == 0
