"""Graph smoothing of vectors, and its grid search.

Nodes lie in few blocks of bounded size, a row per node; links are a row each, in cells by the block of the node
that they pull from. A cell adds up what its links pull, one partial sum per pulling node, and the partial sums of a block's nodes make its new vectors.
A block with more links than a cell takes is sent to several cells, so a node may have any number of links in either direction.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphatlas.functions.vectors import dimension, doubles, unit
from glyphatlas.operators.graph import adjacency, eval_pairs
from glyphatlas.operators.retrieval import hits_at_k
from glyphatlas.operators.vectors import class_cohesion, cohesion_summary
from glyphatlas.session import discard, settle
from glyphatlas.vocab import ALPHA_GRID, N_ITER_GRID, VARIANTS

# Vectors of a block, and links of a cell, that a task holds at a time; there are FEW_BLOCKS until these are full.
BLOCK_BYTES = 64 << 20
CELL_LINKS = 1_000_000
FEW_BLOCKS = 8
_AT_ONCE = 4096


def smoothed(
    vectors: DataFrame, links: DataFrame, settings: Sequence[tuple[float, int]], block_bytes: int = BLOCK_BYTES, cell_links: int = CELL_LINKS,
) -> DataFrame:
    """(alpha, n_iter, id, embedding) for every (alpha, n_iter) of `settings`, and no other.

    Q <- (1 - alpha) Q0 + alpha (mean of the neighbours' Q), n_iter times; nodes without links keep Q0; the
    result is scaled to length 1. `links` is (src, dst, weight) with weights summing to 1 per source.

    A round is linear in Q, so with P_j the plain means taken j times, P_0 = Q0, the result is the sum of (1 - alpha) alpha^j P_j for
    j < n_iter, and alpha^n_iter P_n_iter. The rounds move these P_j only, whatever the number of settings; each setting is their mean by these weights.
    """
    settings = sorted({(float(a), int(n)) for a, n in settings})
    last = max(n for _, n in settings)
    base = settle(vectors.select(F.monotonically_increasing_id().alias("row"), "id", unit(doubles(F.col("embedding"))).alias("q")))
    size = base.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("d")).first()
    n, d, kind = size["n"], size["d"] or 1, base.schema["id"].dataType
    # few blocks: a node has at most one partial sum a block and part
    blocks = max(1, min(FEW_BLOCKS, n // 64), -(-n * d * 8 // block_bytes))
    block = lambda c: F.pmod(F.xxhash64(F.col(c).cast(kind)), F.lit(blocks)).cast("int")
    wires = links.select(F.col("src").cast(kind).alias("src"), F.col("dst").cast(kind).alias("dst"), F.col("weight").cast("double").alias("weight"))
    wires = settle(wires.withColumns({"home": block("src"), "at": block("dst")}))
    parts = settle(wires.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / F.lit(cell_links)).cast("int").alias("parts")))
    # all links of a node into a block make one partial sum, unless they are more than a block has nodes
    often = settle(wires.groupBy("at", "src").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_links).select("at", "src", F.lit(True).alias("often")))
    part = F.pmod(F.when(F.col("often"), F.xxhash64("src", "dst")).otherwise(F.xxhash64("src")), F.col("parts")).cast("int")
    cells = settle(wires.join(parts, "at").join(often, ["at", "src"], "left").select("at", part.alias("part"), "home", "src", "dst", "weight"), replaces=wires)
    state = settle(base.select(block("id").alias("block"), "row", "id", "q"), replaces=base)
    name = kind.simpleString()
    means = [state]
    for _ in range(last):
        every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        shipped = state.join(parts, state["block"] == parts["at"]).select("at", every, "id", "q")
        pulled = cells.groupBy("at", "part").cogroup(shipped.groupBy("at", "part")).applyInArrow(_pulled, f"home int, id {name}, m array<double>")
        state = settle(state.groupBy("block").cogroup(pulled.groupBy("home")).applyInArrow(_mixed, f"block int, row bigint, id {name}, q array<double>"))
        means.append(state)
    each = [m.select(F.lit(j).alias("step"), "row", "id", "q") for j, m in enumerate(means)]
    together = each[0]
    for more in each[1:]:
        together = together.unionByName(more)
    shares = max(1, min(8 * FEW_BLOCKS, n // 64), -(-n * d * 8 * (last + 1) // block_bytes))
    share = F.pmod(F.xxhash64("row"), F.lit(shares)).cast("int")
    mixed = together.withColumn("share", share).groupBy("share").applyInArrow(
        _weighted(settings, last), f"alpha double, n_iter int, id {name}, embedding array<double>")
    done = settle(mixed.withColumn("embedding", unit(F.col("embedding"))))
    discard(*means, cells, parts, often)
    return done


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def _summed(target: np.ndarray, rows: int, values) -> np.ndarray:
    """Sums per target of the rows that `values` gives for slices of them, in order of the target."""
    order = np.argsort(target, kind="stable")
    out = None
    for at in range(0, len(order), _AT_ONCE):
        chosen = order[at:at + _AT_ONCE]
        to = target[chosen]
        first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
        sums = np.add.reduceat(values(chosen), first, axis=0)
        if out is None:
            out = np.zeros((rows, sums.shape[1]))
        out[to[first]] += sums
    return out


def _pulled(links: pa.Table, nodes: pa.Table) -> pa.Table:
    """What the links of a cell pull: the weighted sum of the nodes' vectors per pulling node."""
    empty = pa.table({"home": pa.array([], pa.int32()), "id": pa.array([], nodes.schema.field("id").type), "m": pa.array([], pa.list_(pa.float64()))})
    if not links.num_rows or not nodes.num_rows:
        return empty
    found = pc.index_in(links.column("dst"), value_set=nodes.column("id").combine_chunks())
    links, found = links.filter(found.is_valid()), found.drop_null().to_numpy()
    if not links.num_rows:
        return empty
    q, weight = _matrix(nodes, "q"), links.column("weight").to_numpy()
    named = links.column("src").combine_chunks().dictionary_encode()
    codes = named.indices.to_numpy()
    m = _summed(codes, len(named.dictionary), lambda rows: q[found[rows]] * weight[rows][:, None])
    home = np.zeros(len(m), np.int32)
    home[codes] = links.column("home").to_numpy()
    return pa.table({"home": pa.array(home), "id": named.dictionary, "m": _lists(m)})


def _mixed(nodes: pa.Table, pulled: pa.Table) -> pa.Table:
    """New vectors of a block from the partial sums of its nodes; nodes without one stay as they are."""
    columns = ["block", "row", "id", "q"]
    if not nodes.num_rows or not pulled.num_rows:
        return nodes.select(columns)
    found = pc.index_in(pulled.column("id"), value_set=nodes.column("id").combine_chunks())
    pulled, found = pulled.filter(found.is_valid()), found.drop_null().to_numpy()
    if not pulled.num_rows:
        return nodes.select(columns)
    m = _matrix(pulled, "m")
    total = _summed(found, nodes.num_rows, lambda rows: m[rows])
    seen = np.zeros(nodes.num_rows, bool)
    seen[found] = True
    q = np.where(seen[:, None], total, _matrix(nodes, "q"))
    return pa.table({"block": nodes.column("block"), "row": nodes.column("row"), "id": nodes.column("id"), "q": _lists(q)})


def _weighted(settings: list[tuple[float, int]], last: int):
    """The vectors of every setting from the (step, row, id, q) rows of some nodes, all steps of each."""
    weights = np.zeros((len(settings), last + 1))
    for at, (alpha, n) in enumerate(settings):
        weights[at, :n] = (1 - alpha) * alpha ** np.arange(n)
        weights[at, n] = alpha**n

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.select(["row", "step", "id", "q"]).sort_by([("row", "ascending"), ("step", "ascending")])
        q = _matrix(rows, "q").reshape(rows.num_rows // (last + 1), last + 1, -1)
        ids = rows.column("id").take(pa.array(np.arange(len(q)) * (last + 1)))
        made = []
        for (alpha, n), w in zip(settings, weights, strict=True):
            made.append(pa.table({
                "alpha": pa.array(np.full(len(q), alpha)), "n_iter": pa.array(np.full(len(q), n, np.int32)), "id": ids,
                "embedding": _lists(np.einsum("j,rjd->rd", w, q))}))
        return pa.concat_tables(made)

    return run


def retrofit_variants(
    vectors: DataFrame, links: DataFrame, alphas: Sequence[float], n_iters: Sequence[int], block_bytes: int = BLOCK_BYTES, cell_links: int = CELL_LINKS,
) -> DataFrame:
    """(alpha, n_iter, id, embedding) for every combination."""
    return smoothed(vectors, links, [(a, n) for a in alphas for n in n_iters], block_bytes, cell_links)


def retrofit(vectors: DataFrame, links: DataFrame, alpha: float, n_iter: int) -> DataFrame:
    return smoothed(vectors, links, [(alpha, n_iter)]).select("id", "embedding")


def grid_report(
    vectors: DataFrame,
    split: DataFrame,
    members: DataFrame,
    alphas: Sequence[float] = ALPHA_GRID,
    n_iters: Sequence[int] = N_ITER_GRID,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(grid, classes, counts). The grid has one row per (alpha, n_iter): retrieval of holdout edges, class cohesion, and their change against
    the untouched vectors, which are the row with n_iter 0 (alpha 0). `classes` has the cohesion of every class there, and its change; `counts` is one
    row with the numbers of vectors, edges, training and holdout edges, and evaluated pairs."""
    d = dimension(vectors)
    pairs = settle(eval_pairs(split))
    points = _plain(vectors).unionByName(_grid_points(vectors, split, alphas, n_iters))
    by = ["alpha", "n_iter"]
    hits = hits_at_k(points, pairs, by=tuple(by))
    cohesion = settle(class_cohesion(points, members, tuple(by), d))
    scored = settle(hits.join(cohesion_summary(cohesion, tuple(by)), by, "left"))
    start = scored.where("n_iter = 0")
    change = ("hits_at_10", "hits_at_100", "mrr", "weighted_gap", "mean_gap")
    grid = scored.select(
        "*", *[(F.col(c) - start.select(c).scalar()).alias(f"delta_{c}") for c in change])
    return grid, _against_plain(cohesion), _counts(vectors, split, pairs)


def _plain(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.lit(0.0).alias("alpha"), F.lit(0).alias("n_iter"), "id", unit(doubles(F.col("embedding"))).alias("embedding"))


def _grid_points(vectors: DataFrame, split: DataFrame, alphas: Sequence[float], n_iters: Sequence[int]) -> DataFrame:
    links = adjacency(split.where("split = 'train'").select("from_id", "to_id"))
    return retrofit_variants(vectors, links, alphas, n_iters)


def _against_plain(cohesion: DataFrame) -> DataFrame:
    before = cohesion.where("n_iter = 0").select("class", F.col("gap").alias("_before"))
    return cohesion.join(before, "class").withColumn("delta_gap", F.col("gap") - F.col("_before")).drop("_before")


def _counts(vectors: DataFrame, split: DataFrame, pairs: DataFrame) -> DataFrame:
    part = lambda name: F.count_if(F.col("split") == name)
    return split.agg(F.count(F.lit(1)).alias("n_edges"), part("train").alias("n_train_edges"), part("holdout").alias("n_holdout_edges")).select(
        F.lit(vectors.count()).alias("n_vectors"), "*", F.lit(pairs.count()).alias("n_eval_pairs"))


def grid_classes(
    vectors: DataFrame, split: DataFrame, members: DataFrame, alphas: Sequence[float] = ALPHA_GRID, n_iters: Sequence[int] = N_ITER_GRID,
) -> DataFrame:
    """The classes of `grid_report`; nothing is ranked, so the work is linear in the vectors."""
    points = _plain(vectors).unionByName(_grid_points(vectors, split, alphas, n_iters))
    return _against_plain(settle(class_cohesion(points, members, ("alpha", "n_iter"), dimension(vectors))))


def grid_hits(
    vectors: DataFrame, split: DataFrame, alphas: Sequence[float] = ALPHA_GRID, n_iters: Sequence[int] = N_ITER_GRID,
) -> tuple[DataFrame, DataFrame]:
    """Retrieval of holdout edges at every grid point but the untouched vectors, and the counts of `grid_report`."""
    pairs = settle(eval_pairs(split))
    points = _grid_points(vectors, split, alphas, n_iters)
    return hits_at_k(points, pairs, by=("alpha", "n_iter")), _counts(vectors, split, pairs)


def retrofit_grid(
    vectors: DataFrame, split: DataFrame, members: DataFrame, alphas: Sequence[float] = ALPHA_GRID, n_iters: Sequence[int] = N_ITER_GRID,
) -> DataFrame:
    """The grid of `grid_report`."""
    return grid_report(vectors, split, members, alphas, n_iters)[0]


def winner(grid: DataFrame) -> DataFrame:
    """The first grid point, by alpha then n_iter, with the highest share of hits in the first ten."""
    return grid.where("n_iter > 0").orderBy(F.col("hits_at_10").desc(), "alpha", "n_iter").limit(1)


def variant_vectors(vectors: DataFrame, split: DataFrame, variants=VARIANTS) -> DataFrame:
    """(variant, id, embedding) for named (alpha, n_iter) settings over the training edges."""
    links = adjacency(split.where("split = 'train'").select("from_id", "to_id"))
    points = smoothed(vectors, links, [(a, n) for _, a, n in variants])
    name = F.coalesce(*[F.when((F.col("alpha") == a) & (F.col("n_iter") == n), v) for v, a, n in variants])
    return points.withColumn("variant", name).select("variant", "id", "embedding")
