"""Density clusters by persistence: spanning forest, merge tree, condensed tree, stable clusters.

All steps are joins and aggregates over edges or nodes; loops double pointers or halve components, so their number grows with the
logarithm of the rows, and every round writes what it hands on. A round costs about a second whatever it holds, so tasks follow and join what
they can within ranges of `BLOCK` rows, and rounds are left for what leads from range to range.

* `followed`: chains of pointers, within ranges of nodes first. Pointers that lead from range to range in order need as many rounds as the
  ranges can be halved, however long the chains are.
* `spanning_forest`: Boruvka's rounds over mutual-reachability edges, the last `BLOCK` edges in one task; equal weights are told apart by their
  ends, so the forest is unique.
* `merge_tree`: which edge joins which two components. Trees of more than `BLOCK` edges are halved at their median edge: what the lighter half
  joins becomes one node of the heavier half. A component is named after the edge that completed it, so the halves fit together again by name.
* `condense`: components below `min_size` fall out of a cluster, splits into two larger ones begin new clusters; a cluster is named after its topmost edge.
* `stable_clusters`: the disjoint clusters with the largest summed stability. The best sum below a cluster is max(own, others + next) along a chain, and
  such functions can be composed, so chains of any length fold in a logarithmic number of rounds.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphatlas.operators.components import contract, relabel
from glyphatlas.operators.density import mutual_reachability
from glyphatlas.operators.ranking import with_position
from glyphatlas.session import discard, settle
from glyphatlas.vocab import NOISE

# Rows of pointers or edges that a task follows or joins by itself.
BLOCK = 200_000
# Distances below this count as this, so that densities stay finite.
NEAREST = 1e-9


class _Columns:
    """What carried values are made with, between tables."""

    coalesce, greatest, plus, either = F.coalesce, F.greatest, operator.add, operator.or_


class _Arrays:
    """The same within a task."""

    coalesce, greatest, plus, either = pc.coalesce, pc.max_element_wise, pc.add, pc.or_kleene


# (operations, the values of a node, those of the node it jumps to) -> the new value
Carry = dict[str, Callable]


def followed(pointers: DataFrame, carry: Carry | None = None, block: int = BLOCK) -> DataFrame:
    """(node, root, ...) for (node, parent, ...): the end of every chain of pointers; ends point to themselves.

    A carried column is replaced, jump by jump, by what its function makes of the values of the node and of the node it jumps to. Chains are
    followed within ranges of about `block` nodes; rounds of joins take only the nodes at which a chain enters a further range.
    """
    carry = carry or {}
    given = settle(pointers.select("node", "parent", *carry))
    parts = -(-given.count() // block)
    dealt = given.repartitionByRange(parts, "node") if parts > 1 else given.repartition(1)
    now = settle(dealt.mapInArrow(_within(carry), T.StructType([*given.schema.fields, T.StructField("_open", T.BooleanType())])), replaces=given)
    if parts > 1:
        open_ = now.where("_open")
        entered = settle(now.join(open_.select(F.col("parent").alias("node")).distinct(), "node", "left_semi"))
        while not entered.where("_open").isEmpty():
            entered = settle(entered.where("NOT _open").unionByName(_jumped(entered.where("_open"), entered, carry)), replaces=entered)
        now = settle(now.where("NOT _open").unionByName(_jumped(open_, entered, carry)), replaces=now)
        discard(entered)
    return now.drop("_open").withColumnRenamed("parent", "root")


def _jumped(rows: DataFrame, over: DataFrame, carry: Carry) -> DataFrame:
    """`rows` with the pointers of their parents, which `over` holds."""
    up = over.select(F.col("node").alias("parent"), F.col("parent").alias("_above"), F.col("_open").alias("_further"), *[F.col(c).alias(f"_up_{c}") for c in carry])
    own, above = {c: F.col(c) for c in carry}, {c: F.col(f"_up_{c}") for c in carry}
    values = [how(_Columns, own, above).alias(c) for c, how in carry.items()]
    return rows.drop("_open").join(up, "parent").select("node", F.col("_above").alias("parent"), *values, F.col("_further").alias("_open"))


def _within(carry: Carry):
    """Follows the pointers among the rows of a task; `_open` where a chain leads out of them."""

    def joined(mask, own, up):
        return {c: pc.if_else(mask, how(_Arrays, own, up), own[c]) for c, how in carry.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        node, parent = (table.column(i).to_numpy() for i in (0, 1))
        first = {c: table.column(c).combine_chunks() for c in carry}
        order = np.argsort(node)
        spot = order[np.minimum(np.searchsorted(node, parent, sorter=order), len(node) - 1)]
        inside = node[spot] == parent
        here = np.arange(len(node))
        # a stop is an end or leads out; every node comes to stand before its stop, then takes the pointer of that
        to = np.where(inside, spot, here)
        stop, values = to == here, first
        while not stop[to].all():
            on = ~stop[to]
            values = joined(pa.array(on), values, {c: v.take(pa.array(to)) for c, v in values.items()})
            to = np.where(on, to[to], to)
        values = joined(pa.array(~stop), values, {c: v.take(pa.array(to)) for c, v in first.items()})
        out = [table.column(0), pa.chunked_array([table.column(1).combine_chunks().take(pa.array(to))]), *values.values(), pa.array(~inside[to])]
        yield from pa.table(out, names=["node", "parent", *carry, "_open"]).to_batches(max_chunksize=1 << 16)

    return run


def spanning_forest(edges: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b, weight): the minimum spanning forest of undirected (a, b, weight) edges; of equal weights the smaller ends go first.

    Rounds join every component with its nearest one until at most `block` edges between components are left.
    """
    found = None
    live = settle(edges.select("a", "b", F.struct("weight", "a", "b").alias("e")).where("a <> b"))
    while left := live.count():
        if left <= block:
            chosen = live.repartition(1).sortWithinPartitions("e").mapInArrow(_joining, live.schema).select("e.a", "e.b", "e.weight")
            whole = settle(chosen if found is None else found.unionByName(chosen))
            discard(found, live)
            return whole
        ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))
        best = live.select(F.explode(ends).alias("n"), "e").groupBy(F.col("n.node").alias("node")).agg(F.min(F.struct("e", "n.other")).alias("m"))
        picked = settle(best.select("node", F.col("m.other").alias("other"), "m.e"))
        chosen = picked.select("e.a", "e.b", "e.weight").distinct()
        found, old = settle(chosen if found is None else found.unionByName(chosen)), found
        discard(old)
        back = picked.select(F.col("node").alias("other"), F.col("other").alias("back"))
        # the only cycles are pairs of components that picked the same edge: the smaller one is the end
        ends_here = (F.col("back") == F.col("node")) & (F.col("node") < F.col("other"))
        roots = followed(picked.join(back, "other").select("node", F.when(ends_here, F.col("node")).otherwise(F.col("other")).alias("parent")), block=block)
        live = settle(relabel(live, roots), replaces=live)
        discard(picked)
    return edges.select("a", "b", "weight").where("false") if found is None else found


def _joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, ...) edges in order, those that join two components."""
    parent: dict = {}
    for batch in batches:
        keep = []
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = _top(parent, parent.setdefault(a, a)), _top(parent, parent.setdefault(b, b))
            keep.append(a != b)
            parent[b] = a
        yield batch.filter(pa.array(keep, pa.bool_()))


def _top(parent, i):
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


MERGES = "merge long, weight double, left long, right long, left_size long, right_size long"


def _kruskal(f):
    import pandas as pd

    f = f.sort_values("merge")
    node = pd.unique(pd.concat([f["a"], f["b"]]))
    at = {x: i for i, x in enumerate(node)}
    size = np.zeros(len(node), np.int64)
    parent, name = list(range(len(node))), list(node)
    for side in ("a", "b"):
        size[[at[x] for x in f[side]]] = f[f"size_{side}"]
    size = size.tolist()

    rows = []
    for a, b, merge, weight, n in zip(f["a"], f["b"], f["merge"], f["weight"], f["points"], strict=True):
        i, j = _top(parent, at[a]), _top(parent, at[b])
        rows.append((merge, weight, name[i], name[j], size[i], size[j]))
        if size[i] < size[j]:
            i, j = j, i
        parent[j] = i
        size[i] += size[j]
        name[i] = n + merge
    return pd.DataFrame(rows, columns=["merge", "weight", "left", "right", "left_size", "right_size"])


def merge_tree(forest: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame, int]:
    """(merges, points, n): one row (merge, weight, left, right, left_size, right_size) for every edge of the forest, in order of weight, and (id, node) for the points.

    A node below n is a point; n + m is the component that merge m completed. Points without edges do not occur.
    """
    points = settle(with_position(forest.select(F.explode(F.array("a", "b")).alias("id")).distinct(), [F.col("id")], "node"))
    n = points.count()
    ranked = with_position(forest, [F.col("weight"), F.col("a"), F.col("b")], "merge")
    left, right = (points.select(F.col("id").alias(c), F.col("node").alias(f"_{c}")) for c in ("a", "b"))
    edges = ranked.join(left, "a").join(right, "b").select("merge", "weight", F.col("_a").alias("a"), F.col("_b").alias("b"), F.lit(-1).cast("long").alias("sub"))
    edges = settle(edges)
    sizes = settle(points.select("node", F.lit(1).cast("long").alias("size")))
    while True:
        big = edges.groupBy("sub").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("merge", 0.5).alias("middle")).where(F.col("n") > block)
        big = settle(big.drop("n"))
        if big.isEmpty():
            break
        open_ = edges.join(big, "sub", "left").withColumn("low", F.coalesce(F.col("merge") <= F.col("middle"), F.lit(False)))
        open_ = settle(open_)
        low = open_.where("low")
        roots = contract(low.select("a", "b"))
        tops = low.join(roots.withColumnRenamed("node", "a"), "a").groupBy("root").agg(F.max("merge").alias("top"))
        named = settle(roots.join(tops, "root").select("node", (F.col("top") + n).alias("whole")))
        below = low.join(named.withColumnRenamed("node", "a"), "a").select("merge", "weight", "a", "b", F.col("whole").alias("sub"))
        a, b = (named.select(F.col("node").alias(c), F.col("whole").alias(f"_{c}")) for c in ("a", "b"))
        split = open_.where("NOT low AND middle IS NOT NULL").join(a, "a", "left").join(b, "b", "left")
        above = split.select("merge", "weight", F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"), "sub")
        rest = open_.where("middle IS NULL").select(*above.columns)
        joined = named.join(sizes, "node").groupBy(F.col("whole").alias("node")).agg(F.sum("size").alias("size"))
        sizes = settle(sizes.unionByName(joined), replaces=sizes)
        edges = settle(below.select(*above.columns).unionByName(above).unionByName(rest), replaces=edges)
        discard(open_, named, big)
    a, b = (sizes.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}")) for c in ("a", "b"))
    held = edges.join(a, "a").join(b, "b").withColumn("points", F.lit(n))
    merges = settle(held.groupBy("sub").applyInPandas(_kruskal, MERGES))
    discard(edges, sizes)
    return merges, points, n


def condense(merges: DataFrame, points: DataFrame, n: int, min_size: int) -> tuple[DataFrame, DataFrame]:
    """(clusters, members): (cluster, parent, birth, size, stability) and (id, cluster, density) of the condensed tree.

    `birth` is the density (1 / distance) at which a cluster splits off its parent, 0 without one; a member leaves its cluster at `density`. Points of
    components below `min_size` have no cluster.
    """
    size = F.col("left_size") + F.col("right_size")
    density = 1.0 / F.greatest("weight", F.lit(NEAREST))
    sides = F.array(*[F.struct(F.col(c).alias("node"), F.col(f"{c}_size").alias("node_size")) for c in ("left", "right")])
    splits = F.least("left_size", "right_size") >= min_size
    up = merges.select(F.explode(sides).alias("s"), (F.col("merge") + n).alias("parent"), density.alias("joined"), (size >= min_size).alias("large"), splits.alias("splits"))
    up = up.select("s.node", "s.node_size", "parent", "joined", "large", "splits")
    tops = merges.select((F.col("merge") + n).alias("node"), size.alias("node_size")).join(up.select("node"), "node", "left_anti")
    head = F.col("splits") & (F.col("node_size") >= min_size)
    # a point leaves at the first merge that completes a large component
    links = up.select("node", F.when(head, F.col("node")).otherwise(F.col("parent")).alias("parent"), F.when(F.col("large"), F.col("joined")).alias("leaves"))
    links = links.unionByName(tops.select("node", F.col("node").alias("parent"), F.lit(None).cast("double").alias("leaves")))
    ends = followed(links, {"leaves": lambda op, own, up: op.coalesce(own["leaves"], up["leaves"])})
    heads = up.where(head).select("node", "node_size", F.col("parent").alias("_over"), F.col("joined").alias("birth"))
    heads = heads.unionByName(tops.where(F.col("node_size") >= min_size).select("node", "node_size", F.lit(None).cast("long").alias("_over"), F.lit(0.0).alias("birth")))
    over = ends.select(F.col("node").alias("_over"), F.col("root").alias("parent"))
    bare = settle(heads.join(over, "_over", "left").select(F.col("node").alias("cluster"), "parent", "birth", F.col("node_size").alias("size")))
    known = bare.select("cluster")
    members = settle(points.join(ends, "node").select("id", F.col("root").alias("cluster"), F.col("leaves").alias("density")).join(known, "cluster", "left_semi"))
    born = bare.select("cluster", F.col("birth").alias("start"))
    from_points = members.join(born, "cluster").groupBy("cluster").agg(F.sum(F.col("density") - F.col("start")).alias("s"))
    parts = bare.where("parent IS NOT NULL").select(F.col("parent").alias("cluster"), "birth", "size").join(born, "cluster")
    from_parts = parts.groupBy("cluster").agg(F.sum((F.col("birth") - F.col("start")) * F.col("size")).alias("s"))
    total = from_points.unionByName(from_parts).groupBy("cluster").agg(F.sum("s").alias("stability"))
    clusters = settle(bare.join(total, "cluster", "left").withColumn("stability", F.coalesce("stability", F.lit(0.0))), replaces=None)
    discard(ends, bare)
    return clusters, members


def best_sums(tree: DataFrame) -> DataFrame:
    """(cluster, best, below) for (cluster, parent, stability): the largest summed stability of disjoint clusters at or below each, and strictly below it."""
    done = None
    open_ = settle(tree.select("cluster", "parent", "stability"))
    while not open_.isEmpty():
        # a cluster whose parts are all known is known; one with a single unknown part is a link of a chain
        waits = open_.groupBy(F.col("parent").alias("cluster")).agg(F.count(F.lit(1)).alias("unknown"), F.max("cluster").alias("next"))
        gained = None if done is None else done.groupBy(F.col("parent").alias("cluster")).agg(F.sum("best").alias("gained"))
        state = open_.join(waits, "cluster", "left")
        state = state.withColumn("gained", F.lit(0.0)) if gained is None else state.join(gained, "cluster", "left")
        state = settle(state.select("cluster", "parent", "stability", F.coalesce("unknown", F.lit(0)).alias("unknown"), "next", F.coalesce("gained", F.lit(0.0)).alias("gained")))
        link = F.col("unknown") == 1
        # best(next) -> max(own, others + best(next)) along a chain; an end carries max(own, -) and nothing more
        steps = [F.when(link, F.col("stability")).otherwise(F.lit(float("-inf"))).alias("own"), F.when(link, F.col("gained")).otherwise(F.lit(0.0)).alias("others")]
        chain = followed(
            state.select(F.col("cluster").alias("node"), F.when(link, F.col("next")).otherwise(F.col("cluster")).alias("parent"), *steps),
            {"own": lambda op, f, g: op.greatest(f["own"], op.plus(f["others"], g["own"])), "others": lambda op, f, g: op.plus(f["others"], g["others"])})
        ends = state.where("unknown = 0").select(F.col("cluster").alias("root"), F.greatest("stability", "gained").alias("value"))
        solved = chain.join(ends, "root").select(F.col("node").alias("cluster"), F.greatest("own", F.col("others") + F.col("value")).alias("best"))
        fresh = state.join(solved, "cluster").select("cluster", "parent", "stability", "best")
        now = settle(fresh if done is None else done.unionByName(fresh))
        left = settle(open_.join(now.select("cluster"), "cluster", "left_anti"), replaces=open_)
        discard(done, state, chain)
        done, open_ = now, left
    if done is None:
        return tree.select("cluster", F.lit(0.0).alias("best"), F.lit(0.0).alias("below")).where("false")
    below = done.groupBy(F.col("parent").alias("cluster")).agg(F.sum("best").alias("below"))
    return done.join(below, "cluster", "left").select("cluster", "best", F.coalesce("below", F.lit(0.0)).alias("below"))


def stable_clusters(tree: DataFrame) -> DataFrame:
    """(cluster): the disjoint clusters of (cluster, parent, stability) with the largest summed stability; a cluster wins against its parts if it is as stable."""
    picks = tree.join(best_sums(tree), "cluster").select("cluster", "parent", ((F.col("stability") >= F.col("below")) & (F.col("stability") >= 0)).alias("picked"))
    picks = settle(picks)
    # a cluster counts unless one above it is picked
    start = picks.select(F.col("cluster").alias("node"), F.coalesce("parent", "cluster").alias("parent"), F.col("picked").alias("above"))
    over = picks.select(F.col("cluster").alias("parent"), F.col("picked").alias("over"))
    links = start.join(over, "parent").select("node", "parent", (F.col("over") & (F.col("parent") != F.col("node"))).alias("above"))
    seen = followed(links, {"above": lambda op, own, up: op.either(own["above"], up["above"])})
    free = seen.where("NOT above").select(F.col("node").alias("cluster"))
    return settle(picks.where("picked").join(free, "cluster", "left_semi").select("cluster"))


def stable_layers(neighbours: DataFrame, min_size: int = 20, min_clusters: int = 4, max_layers: int = 5) -> DataFrame:
    """(id, layer, cluster_id): nested clusters of the neighbour lists (src, dst, distance), layer 0 the coarsest; -1 marks noise.

    The finest layer holds the most stable clusters of the condensed tree, each coarser one the most stable clusters that have clusters of the finer one
    strictly inside. Coarser layers with fewer than `min_clusters` clusters are left out. The whole of the points is a cluster only if nothing splits off it.
    """
    lists = settle(neighbours.select("src", "dst", "distance"))
    ids = settle(lists.select(F.col("src").alias("id")).distinct())
    forest = spanning_forest(mutual_reachability(lists))
    clusters, members = condense(*merge_tree(forest), min_size)
    alone = clusters.where("parent IS NULL").count() == 1 and clusters.count() > 1
    whole = F.col("parent").isNull() & F.lit(alone)
    tree = settle(clusters.select("cluster", "parent", "size", F.when(whole, F.lit(-1.0)).otherwise(F.col("stability")).alias("stability")))
    layers: list[DataFrame] = []
    inside = tree
    while len(layers) < max_layers:
        chosen = stable_clusters(inside)
        many = chosen.count()
        if not many or layers and many < min_clusters:
            break
        layers.append(chosen)
        # the clusters strictly above the chosen ones
        links = inside.join(chosen.withColumn("hit", F.lit(True)), "cluster", "left").select("cluster", "parent", F.coalesce("hit", F.lit(False)).alias("hit"))
        lowest = _above(links)
        inside = settle(inside.join(lowest, "cluster", "left_semi"))
        if inside.isEmpty():
            break
    out = None
    for layer, chosen in enumerate(reversed(layers)):
        named = with_position(tree.join(chosen, "cluster").select("cluster", "size"), [F.col("size").desc(), F.col("cluster")], "cluster_id")
        held = tree.join(chosen.withColumn("hit", F.lit(True)), "cluster", "left")
        ends = followed(held.select(F.col("cluster").alias("node"), F.when(F.col("hit"), F.col("cluster")).otherwise(F.coalesce("parent", "cluster")).alias("parent")))
        owned = ends.join(named.withColumnRenamed("cluster", "root"), "root").select(F.col("node").alias("cluster"), "cluster_id")
        rows = ids.join(members.select("id", "cluster").join(owned, "cluster"), "id", "left")
        rows = rows.select("id", F.lit(layer).alias("layer"), F.coalesce("cluster_id", F.lit(NOISE)).cast("bigint").alias("cluster_id"))
        out = rows if out is None else out.unionByName(rows)
    return ids.select("id", F.lit(0).alias("layer"), F.lit(NOISE).cast("bigint").alias("cluster_id")) if out is None else out


def _above(links: DataFrame) -> DataFrame:
    """(cluster) strictly above a hit of (cluster, parent, hit): every hit marks its parent, marks travel up by doubled pointers."""
    marked = settle(links.where("hit AND parent IS NOT NULL").select(F.col("parent").alias("cluster")).distinct())
    jump = settle(links.where("parent IS NOT NULL").select("cluster", "parent"))
    while True:
        more = jump.join(marked, "cluster", "left_semi").select(F.col("parent").alias("cluster"))
        wider = settle(marked.unionByName(more).distinct())
        up = jump.select(F.col("cluster").alias("parent"), F.col("parent").alias("_p"))
        longer = settle(jump.join(up, "parent").select("cluster", F.col("_p").alias("parent")))
        discard(jump, marked)
        marked, jump = wider, longer
        if jump.isEmpty():
            return marked


__all__ = ["best_sums", "condense", "followed", "merge_tree", "spanning_forest", "stable_clusters", "stable_layers"]
