"""Exact and approximate nearest neighbours, the weighted neighbour graph, principal axes and a 2-D layout."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphatlas.functions.vectors import dot, doubles, unit
from glyphatlas.operators.ranking import top_rows
from glyphatlas.operators.selection import sample_order
from glyphatlas.session import cut_lineage, discard, settle, shuffle_width
from glyphatlas.vocab import MIN_DIST, N_NEIGHBORS, SPLIT_SEED

MAX_PIVOTS = 1024
DIST_DIGITS = 9
# Rows that place the hyperplanes of the approximate search, and the cuts kept ready for leaves that come out too large.
PLANE_SAMPLE = 10_000
FURTHER_CUTS = 16
# The share of the exact neighbours that the approximate search is meant to find.
RECALL = 0.95
# Descent ends when a round renews less than this share of the lists, or after twice as many rounds as the rows can be halved.
UPDATE_RATE = 0.001
LIST_SALTS = 32
# Distances to pivots that a task holds at a time.
PIVOT_CELLS = 1 << 19
# Rows of a block of the exact search, and in at most so many dimensions.
BLOCK_ROWS = 4096
SMALL_BLOCK_ROWS = 512
FEW_DIMENSIONS = 4
# Groups of blocks of the exact search, and the most blocks of a group: 65,536 rows at the default size of a block.
FEW_GROUPS = 8
LARGEST_GROUP = 16
# Nodes that a round of the layout draws its repelling nodes from.
SAMPLED = 4096
# All forces on a node are added up in a round, so steps are far smaller than in one-edge-at-a-time descent.
FIRST_STEP = 0.1


def knn(vectors: DataFrame, k: int = N_NEIGHBORS, metric: str = "cosine", block_rows: int | None = None) -> DataFrame:
    """(src, dst, rank, distance): the k nearest other rows of every row, ties by id. Exact.

    1. Copies are folded: only distinct vectors are compared, and the lists are handed to the copies after.
    2. Pivots (at most MAX_PIVOTS) cut the space into cells; large cells are cut into blocks by hash.
    3. A row's own block bounds its k-th distance; by the triangle inequality only cells whose ball, and whose half of the space between
       their pivot and the row's own, come within that bound can hold a nearer row. Blocks are dealt to groups, and the row is sent once to each group
       that holds a block of such a cell. There are few groups, so a row is sent a few times even if no cell is out of its reach.
    4. A group compares a row with its blocks of those cells, one bounded matrix product each, and returns at most k rows per query. Cosines are
       compared in single precision first, with a bound of its error; what passes is worked out again. The bound shrinks on the way.
    In few dimensions most cells are out of reach, so blocks are small there unless `block_rows` says otherwise.
    The lists are written once, however often the caller reads them.
    """
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    v = doubles(F.col("embedding"))
    points = cut_lineage(vectors.select("id", (unit(v) if metric == "cosine" else v).alias("v")))
    distinct = cut_lineage(points.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")))
    sizes = distinct.agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("n"), F.max(F.size("v")).alias("dim")).first()
    if not sizes["d"]:
        return _empty_lists(points)
    block_rows = block_rows or (BLOCK_ROWS if sizes["dim"] > FEW_DIMENSIONS else SMALL_BLOCK_ROWS)
    near = _distinct_neighbours(distinct.select("id", "v"), sizes["d"], k, metric, block_rows)
    if sizes["d"] < sizes["n"]:
        near = _hand_to_copies(points, distinct, settle(near), k, metric)
    ranked = near.withColumn("rank", F.row_number().over(_by_distance("src")).cast("bigint"))
    return settle(ranked.where(F.col("rank") <= k).select("src", "dst", "rank", "distance"))


def knn_approximate(
    vectors: DataFrame, k: int = N_NEIGHBORS, metric: str = "cosine", leaf_rows: int = 1024, tables: int = 4, seed: int = SPLIT_SEED,
    held: int | None = None,
) -> DataFrame:
    """(src, dst, rank, distance) like `knn`, with nearly all of the nearest rows, by comparisons that grow with the rows alone.

    1. Every table cuts the space by its own random hyperplanes, through medians of at most PLANE_SAMPLE rows, into leaves of
       about `leaf_rows`; a leaf that came out larger is cut by further hyperplanes. Rows that share a leaf in any
       table are compared by one bounded matrix product. A single leaf is exact.
    2. Neighbours of neighbours: see `descend`. Lists of `held` rows (twice `k`) are kept on the way. A single table would leave no way from
       leaf to leaf, so there are at least two.
    Copies are folded first, so no leaf and no list is full of equal rows.
    """
    return knn_counted(vectors, k, metric, leaf_rows, tables, seed, held)[0]


def knn_counted(
    vectors: DataFrame, k: int = N_NEIGHBORS, metric: str = "cosine", leaf_rows: int = 1024, tables: int = 4, seed: int = SPLIT_SEED,
    held: int | None = None,
) -> tuple[DataFrame, dict[str, float]]:
    """The lists of `knn_approximate`, and how they came about: cuts, rounds, and comparisons per distinct row."""
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    v = doubles(F.col("embedding"))
    points = settle(vectors.select("id", (unit(v) if metric == "cosine" else v).alias("v")))
    distinct = settle(points.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")))
    sizes = distinct.agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("n"), F.max(F.size("v")).alias("dim")).first()
    if not sizes["d"]:
        return _empty_lists(points), {"cuts": 0, "rounds": 0, "per_row": 0.0}
    alone = distinct.select("id", "v")
    depth = max(0, int(np.ceil(np.log2(sizes["d"] / leaf_rows))))
    if not depth:  # a single leaf
        near = _within_leaves(alone, depth, sizes["dim"], k, metric, leaf_rows, 1, seed)
        how = {"cuts": 0, "rounds": 0, "per_row": (sizes["d"] - 1) / 2}
    else:
        sample = np.array([r["v"] for r in top_rows(alone, PLANE_SAMPLE, sample_order(seed)).collect()])
        held, tables = held or 2 * k, max(2, tables)
        leaves = settle(_leaves(alone, depth, sizes["dim"], leaf_rows, tables, seed, sample))
        pairs = F.sum((F.col("n") * (F.col("n") - 1) / 2)).alias("p")
        compared = leaves.groupBy("leaf", "more").agg(F.count(F.lit(1)).alias("n")).agg(pairs).first()["p"]
        first = settle(_nearest(_compared_leaves(leaves, held, metric), held))
        discard(leaves)
        near, rounds, more = descend(alone, first, sizes["d"], held, metric, seed)
        how = {"cuts": depth, "rounds": rounds, "per_row": (compared + more) / sizes["d"]}
    if sizes["d"] < sizes["n"]:
        near = _hand_to_copies(points, distinct, near, k, metric)
    ranked = near.withColumn("rank", F.row_number().over(_by_distance("src")).cast("bigint"))
    return ranked.where(F.col("rank") <= k).select("src", "dst", "rank", "distance"), how


def descend(points: DataFrame, near: DataFrame, n: int, held: int, metric: str, seed: int = SPLIT_SEED) -> tuple[DataFrame, int, int]:
    """Renew the lists `near` (src, dst, distance) of `n` rows by neighbours of neighbours, until few entries change; also the number of rounds and of comparisons.

    In a round every row gathers the rows of its list and, drawn by a hash, at most as many rows that list it. Of these it
    compares those that have not met: pairs with an entry that is new since the last round. A pair is handed on only where it
    is nearer than the worst entry of a list. A row compares at most 2 * `held` rows, however many list it.
    """
    lists = near.withColumn("new", F.lit(True))
    compared = 0
    last = max(1, 2 * int(np.ceil(np.log2(max(n, 2)))))
    kind = points.schema["id"].dataType
    found = T.StructType([T.StructField("src", kind), T.StructField("dst", kind), T.StructField("distance", T.DoubleType())])
    for turn in range(1, last + 1):
        forward = lists.select(F.col("src").alias("at"), F.col("dst").alias("id"), "new")
        draw = F.xxhash64(F.lit(seed), F.lit(turn), "src", "dst")
        backward = _first_of(lists.select(F.col("dst").alias("at"), F.col("src").alias("id"), "new", draw.alias("_d")), "at", [F.col("_d"), F.col("id")], held, "id")
        gathered = settle(forward.unionByName(backward.select("at", "id", "new")).groupBy("at", "id").agg(F.max("new").alias("new")))
        met = gathered.groupBy("at").agg(F.sum(F.col("new").cast("long")).alias("a"), F.count(F.lit(1)).alias("b")).where("a > 0")
        compared += met.agg(F.sum(F.col("a") * (F.col("a") - 1) / 2 + F.col("a") * (F.col("b") - F.col("a")))).first()[0] or 0
        worst = lists.groupBy("src").agg(F.when(F.count(F.lit(1)) >= held, F.max("distance")).otherwise(F.lit(float("inf"))).alias("worst"))
        known = points.join(worst.withColumnRenamed("src", "id"), "id", "left").select("id", "v", F.coalesce("worst", F.lit(float("inf"))).alias("worst"))
        shipped = gathered.join(met.select("at"), "at", "left_semi").join(known, "id").select("at", "id", "new", "worst", "v")
        dealt = shipped.repartition(shuffle_width(points.sparkSession), "at").sortWithinPartitions("at", "id")
        better = dealt.mapInArrow(_meetings(metric), found)
        merged = lists.select("src", "dst", "distance", F.lit(False).alias("new")).unionByName(better.withColumn("new", F.lit(True)))
        # an entry that was there before is not new
        each = merged.groupBy("src", "dst").agg(F.min("distance").alias("distance"), F.min("new").alias("new"))
        renewed = settle(_nearest(each, held, "new"), replaces=lists if turn > 1 else near)
        discard(gathered)
        lists = renewed
        if lists.where("new").count() <= UPDATE_RATE * held * n:
            break
    return lists.select("src", "dst", "distance"), turn, int(compared)


def _meetings(metric: str):
    """For groups of (at, id, new, worst, v) rows: the pairs with a new member that are nearer than the worst entry of a list."""

    def pairs(batch: pa.Table) -> pa.RecordBatch:
        at, ids, new, worst = (batch.column(i).to_numpy() for i in range(4))
        flat = batch.column(4).combine_chunks()
        x = flat.flatten().to_numpy().reshape(len(ids), -1)
        edges = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
        src, dst, dist = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            d = _distances(x[a:b], x[a:b], metric)
            fresh = new[a:b]
            good = (fresh[:, None] | fresh[None, :]) & (d < worst[a:b, None])
            np.fill_diagonal(good, False)
            i, j = np.nonzero(good)
            src.append(i + a)
            dst.append(j + a)
            dist.append(d[i, j])
        column = batch.column(1).combine_chunks()
        return pa.RecordBatch.from_arrays([column.take(pa.array(np.concatenate(src))), column.take(pa.array(np.concatenate(dst))), pa.array(np.concatenate(dist))], ["src", "dst", "distance"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            at = table.column(0).to_numpy()
            whole = int(np.flatnonzero(at != at[-1])[-1]) + 1 if at[0] != at[-1] else 0
            if whole:
                yield pairs(table.slice(0, whole))
            rest = table.slice(whole)
        if rest is not None:
            yield pairs(rest)

    return run


def _first_of(rows: DataFrame, key: str, order: list[Column], most: int, spread: str) -> DataFrame:
    """The first `most` rows of every key. A key may hold a large share of all rows: they are cut down in LIST_SALTS parts first."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(LIST_SALTS)))
    for by in ([key, "_salt"], [key]):
        salted = salted.withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_r") <= most).drop("_r")
    return salted.drop("_salt")


def _nearest(pairs: DataFrame, most: int, *more: str) -> DataFrame:
    return _first_of(pairs, "src", [F.col("distance"), F.col("dst")], most, "dst").select("src", "dst", "distance", *more)


def _within_leaves(points: DataFrame, depth: int, dim: int, k: int, metric: str, leaf_rows: int, tables: int, seed: int, sample: np.ndarray | None = None) -> DataFrame:
    """(src, dst, distance): the k nearest rows in each leaf of each table, a pair once."""
    return _compared_leaves(_leaves(points, depth, dim, leaf_rows, tables, seed, sample), k, metric)


def _leaves(points: DataFrame, depth: int, dim: int, leaf_rows: int, tables: int, seed: int, sample: np.ndarray | None = None) -> DataFrame:
    """(id, v, leaf, more): the leaf of every row in every table, and its part of a leaf that was cut further."""
    planes = np.random.default_rng(seed).normal(size=(tables, depth + FURTHER_CUTS, dim))
    middle = np.zeros(planes.shape[:2]) if sample is None else np.median(np.einsum("tcd,nd->tcn", planes, sample), axis=2)

    def side(frames):
        import pandas as pd

        for f in frames:
            if len(f):
                x = np.stack(f["v"].to_numpy())
                for t in range(tables):
                    bits = (x @ planes[t].T > middle[t]).astype("int64")
                    weight = 1 << np.arange(bits.shape[1], dtype="int64")
                    yield pd.DataFrame({"id": f["id"], "v": f["v"], "leaf": t + tables * (bits[:, :depth] @ weight[:depth]), "more": bits[:, depth:] @ weight[:FURTHER_CUTS]})

    whole = T.LongType()
    cut = points.mapInPandas(side, T.StructType([
        *points.schema.fields, T.StructField("leaf", whole), T.StructField("more", whole)]))
    counts = cut.groupBy("leaf").agg(F.count(F.lit(1)).alias("_n"))  # one row per leaf
    further = F.least(F.greatest(F.ceil(F.log2(F.col("_n") / leaf_rows)), F.lit(0)), F.lit(FURTHER_CUTS)).cast("int")
    return cut.join(counts, "leaf").withColumn("more", F.expr("more") % F.pow(F.lit(2), further).cast("bigint")).drop("_n")


def _compared_leaves(leaves: DataFrame, k: int, metric: str) -> DataFrame:
    lists = T.StructType([
        T.StructField("src", leaves.schema["id"].dataType), T.StructField("dst", leaves.schema["id"].dataType), T.StructField("distance", T.DoubleType())])

    def within(f):
        import pandas as pd

        f = f.sort_values("id")
        ids, x = f["id"].to_numpy(), np.stack(f["v"].to_numpy())
        most = min(k, len(ids) - 1)
        src, dst, dist = [ids[:0]], [ids[:0]], [np.zeros(0)]
        for at in range(0, len(ids) if most else 0, 512):
            block = x[at : at + 512]
            d = _distances(block, x, metric)
            rows = np.arange(len(block))
            d[rows, rows + at] = np.inf
            near = np.argpartition(d, most - 1, axis=1)[:, :most]
            src.append(np.repeat(ids[at : at + 512], most))
            dst.append(ids[near.ravel()])
            dist.append(d[rows[:, None], near].ravel())
        return pd.DataFrame({"src": np.concatenate(src), "dst": np.concatenate(dst), "distance": np.concatenate(dist)})

    return leaves.groupBy("leaf", "more").applyInPandas(within, lists).groupBy("src", "dst").agg(F.min("distance").alias("distance"))


def _distances(block: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        return np.round(1.0 - block @ x.T, DIST_DIGITS)
    sq = (block**2).sum(1)[:, None] + (x**2).sum(1)[None, :] - 2 * block @ x.T
    return np.round(np.sqrt(np.maximum(sq, 0)), DIST_DIGITS)


def _by_distance(key: str):
    return W.partitionBy(key).orderBy("distance", "dst")


def _empty_lists(points: DataFrame) -> DataFrame:
    return points.select(
        F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0).cast("bigint").alias("rank"),
        F.lit(0.0).alias("distance")).where("false")


def _distinct_neighbours(points: DataFrame, n: int, k: int, metric: str, block_rows: int) -> DataFrame:
    n_pivots = min(MAX_PIVOTS, max(1, n // block_rows))
    subs, radius = np.zeros(n_pivots, dtype="int64"), np.full(n_pivots, -np.inf)
    id_type = points.schema["id"].dataType
    if n_pivots == 1:
        celled = points.withColumn("cell", F.lit(0))
        subs[0], radius[0], pivots = -(-n // block_rows), np.inf, None
    else:
        pivots = np.array([r["v"] for r in top_rows(points, n_pivots, sample_order(SPLIT_SEED)).collect()])

        def squares(block):
            return np.maximum((block**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * block @ pivots.T, 0.0)

        def slip(block):
            """More than squares are off by."""
            return 1e-11 * (1 + np.fmax.reduce((block**2).sum(1)) + (pivots**2).sum(1).max())

        def assign(frames):
            for f in frames:
                for at in range(0, len(f), PIVOT_CELLS // n_pivots):
                    part = f.iloc[at : at + PIVOT_CELLS // n_pivots]
                    d = np.sqrt(squares(np.stack(part["v"].to_numpy())))
                    yield part.assign(cell=d.argmin(1).astype("int32"), reach=d.min(1))

        celled = cut_lineage(points.mapInPandas(assign, T.StructType(
            points.schema.fields + [T.StructField("cell", T.IntegerType()), T.StructField("reach", T.DoubleType())])))
        # at most MAX_PIVOTS rows
        for c in celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("r")).collect():
            subs[c["cell"]] = -(-c["n"] // block_rows)
            radius[c["cell"]] = c["r"]
    slack = 4e-9 if metric == "cosine" else 1e-8

    def distances(a, b):
        """Not rounded."""
        if metric == "cosine":
            return 1.0 - a @ b.T
        sq = np.zeros((len(a), len(b)))
        for j in range(a.shape[1]):  # plain differences: the product form loses small distances
            sq += (a[:, j][:, None] - b[:, j][None, :]) ** 2
        return np.sqrt(sq)

    def within_reach(block, kth, apart=[]):  # noqa: B006
        """Which cells may hold a row at a distance of at most `kth`."""
        if pivots is None:
            return np.ones((len(block), 1), bool)
        if not apart:  # once a task
            apart.append(np.sqrt(squares(pivots) + slip(pivots)))
        bound = (np.sqrt(np.maximum(2 * kth, 0) + slack) if metric == "cosine" else kth + slack)[:, None] + 1e-7
        sq = squares(block)
        near = np.sqrt(sq) - radius[None, :] <= bound
        # a row of another cell lies beyond the middle between both pivots
        own = sq.argmin(1)
        return near & (sq - sq.min(1)[:, None] <= 2 * apart[0][own] * bound + slip(block))

    def close(a, b, most):
        """(row, column, rounded distance) of the pairs at a rounded distance of at most `most` of the row."""
        if metric == "cosine":
            # rounding to single precision, and at every step of the sum
            room = 1.02 * (a.shape[1] + 4) * 2.0**-24 * float(np.sqrt(np.fmax.reduce((a**2).sum(1)) * np.fmax.reduce((b**2).sum(1)))) + slack
            least = (1.0 - most - room).astype(np.float32)
            i, j = np.divmod(np.flatnonzero(a.astype(np.float32) @ b.astype(np.float32).T >= np.nextafter(least, np.float32(-np.inf))[:, None]), len(b))
            d = np.concatenate([np.zeros(0), *[1.0 - np.einsum("ij,ij->i", a[i[s : s + 65536]], b[j[s : s + 65536]]) for s in range(0, len(i), 65536)]])
        else:
            d = distances(a, b)
            i, j = np.divmod(np.flatnonzero(d <= most[:, None] + slack), len(b))
            d = d[i, j]
        good = d <= most[i] + slack
        return i[good], j[good], np.round(d[good], DIST_DIGITS)

    per_cell = lambda values: F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("cell") + 1)
    blocks = celled.select("id", "v", "cell", F.pmod(F.xxhash64("id"), per_cell(subs)).cast("int").alias("sub"))
    # blocks are dealt to groups, block by block: a row is sent to a group once, however many blocks of it it visits
    n_groups = _groups(n, block_rows)
    first = np.concatenate([[0], np.cumsum(subs)[:-1]])
    holds = np.zeros((n_pivots, n_groups), dtype=np.float32)
    for cell in range(n_pivots):
        holds[cell, (first[cell] + np.arange(subs[cell])) % n_groups] = 1
    dealt = blocks.withColumn("group", F.pmod(per_cell(first) + F.col("sub"), F.lit(n_groups)).cast("int"))
    bounded = T.StructType([T.StructField("id", id_type), points.schema["v"], T.StructField("kth", T.DoubleType())])
    if int(subs.sum()) == 1:
        visits = blocks.select("id", "v", F.lit(float("inf")).alias("kth"), F.lit(0).alias("group"))
    else:

        def own_bound(f):
            x = np.stack(f["v"].to_numpy())
            kth = np.full(len(f), np.inf)
            if len(f) > k:
                for at in range(0, len(f), 1024):
                    d = distances(x[at : at + 1024], x)
                    d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
                    kth[at : at + 1024] = np.round(np.partition(d, k - 1, axis=1)[:, k - 1], DIST_DIGITS)
            f["kth"] = kth
            return f[["id", "v", "kth"]]

        def route(frames):
            for f in frames:
                for at in range(0, len(f), PIVOT_CELLS // n_pivots):
                    part = f.iloc[at : at + PIVOT_CELLS // n_pivots]
                    near = within_reach(np.stack(part["v"].to_numpy()), part["kth"].to_numpy()).astype(np.float32) @ holds
                    yield part.assign(groups=[np.flatnonzero(row).astype("int32") for row in near])

        routed = blocks.groupBy("cell", "sub").applyInPandas(own_bound, bounded).mapInPandas(route, T.StructType(
            bounded.fields + [T.StructField("groups", T.ArrayType(T.IntegerType()))]))
        visits = cut_lineage(routed).select("id", "v", "kth", F.explode("groups").alias("group"))
    parts = np.ones(n_groups, dtype="int64")
    for c in visits.groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect():
        parts[c["group"]] = _groups(c["n"], block_rows)
    per_group = F.element_at(F.array(*[F.lit(int(x)) for x in parts]), F.col("group") + 1)
    asked = visits.withColumn("part", F.pmod(F.xxhash64("id"), per_group).cast("int"))
    offered = dealt.select("id", "v", "cell", "group", F.explode(F.sequence(F.lit(0), (per_group - 1).cast("int"))).alias("part"))
    lists = T.StructType([
        T.StructField("src", id_type), T.StructField("dst", id_type), T.StructField("distance", T.DoubleType())])

    def leading(row, col, value, ids):
        """The first k of every row."""
        order = np.lexsort((ids[col], value, row))
        row, col, value = row[order], col[order], value[order]
        best = np.arange(len(row)) - np.searchsorted(row, row) < k
        return row[best], col[best], value[best]

    def nearest(q, c):
        import pandas as pd

        src, dst, dist = [], [], []
        if len(q) and len(c):
            c = c.sort_values(["cell", "id"])
            ids, x, cells = c["id"].to_numpy(), np.stack(c["v"].to_numpy()), c["cell"].to_numpy()
            begin = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
            pieces = [(int(cells[a]), i, min(i + block_rows, b)) for a, b in zip(begin, [*begin[1:], len(cells)], strict=True) for i in range(a, b, block_rows)]
            qid, qx, kth = q["id"].to_numpy(), np.stack(q["v"].to_numpy()), q["kth"].to_numpy().copy()
            for at in range(0, len(q), 512):
                spot = slice(at, at + 512)
                near = within_reach(qx[spot], kth[spot])
                rows, cols, values = [], [], []
                seen, begun = 0, 0
                for cell, a, b in pieces:
                    row = np.flatnonzero(near[:, cell])
                    if not len(row):
                        continue
                    if b - a > k:  # rows without a bound get one here; the row itself may be among the first k + 1
                        bare = row[np.isinf(kth[at + row])]
                        if len(bare):
                            kth[at + bare] = np.round(np.partition(distances(qx[at + bare], x[a:b]), k, axis=1)[:, k], DIST_DIGITS)
                    i, j, d = close(qx[at + row], x[a:b], kth[at + row])
                    other = qid[at + row[i]] != ids[a + j]
                    rows.append(row[i][other])
                    cols.append(a + j[other])
                    values.append(d[other])
                    seen += len(rows[-1])
                    if seen > 2 * begun + 4 * k * len(near):  # only the first k of what was found so far may stay
                        rows, cols, values = ([x] for x in leading(np.concatenate(rows), np.concatenate(cols), np.concatenate(values), ids))
                        seen = begun = len(rows[0])
                        full = np.flatnonzero(np.bincount(rows[0], minlength=len(near)) == k)
                        if len(full):
                            last = np.searchsorted(rows[0], full, "right") - 1
                            kth[at + full] = np.minimum(kth[at + full], values[0][last])
                if not rows:
                    continue
                row, col, value = leading(np.concatenate(rows), np.concatenate(cols), np.concatenate(values), ids)
                src.append(qid[at + row])
                dst.append(ids[col])
                dist.append(value)
        if not src:
            return pd.DataFrame({"src": [], "dst": [], "distance": []})
        return pd.DataFrame({"src": np.concatenate(src), "dst": np.concatenate(dst), "distance": np.concatenate(dist)})

    keys = ["group", "part"]
    return asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInPandas(nearest, lists)


def _groups(rows: int, block_rows: int) -> int:
    """Into how many groups rows go: FEW_GROUPS of them, so that what is sent grows with the rows, until a group holds LARGEST_GROUP blocks."""
    return max(1, min(FEW_GROUPS, 8 * rows // block_rows), -(-rows // (LARGEST_GROUP * block_rows)))


def _hand_to_copies(points: DataFrame, distinct: DataFrame, near: DataFrame, k: int, metric: str) -> DataFrame:
    """Neighbour lists of all rows from those of the distinct vectors; at most k+1 copies enter a list."""
    members = cut_lineage(points.join(distinct.select("v", F.col("id").alias("rep")), "v").select("id", "rep"))
    first = members.withColumn("_r", F.row_number().over(W.partitionBy("rep").orderBy("id"))).where(F.col("_r") <= k + 1)
    best = near.withColumn("_r", F.row_number().over(_by_distance("src"))).where(F.col("_r") <= k).drop("_r")
    own = F.round(1 - dot(F.col("v"), F.col("v")), DIST_DIGITS) if metric == "cosine" else F.lit(0.0)
    lists = best.unionByName(distinct.select(F.col("id").alias("src"), F.col("id").alias("dst"), own.alias("distance")))
    named = lists.join(first.select(F.col("rep").alias("dst"), F.col("id").alias("copy")), "dst").select(
        F.col("src").alias("rep"), F.col("copy").alias("dst"), "distance")
    short = named.withColumn("_r", F.row_number().over(_by_distance("rep"))).where(F.col("_r") <= k + 1).drop("_r")
    return members.join(short, "rep").select(F.col("id").alias("src"), "dst", "distance").where("src <> dst")


def fuzzy_graph(neighbours: DataFrame, steps: int = 64) -> DataFrame:
    """(a, b, weight): undirected fuzzy neighbour weights.

    Per row, rho is the smallest positive distance and sigma is found by bisection so that the summed
    memberships exp(-max(0, d - rho) / sigma) equal log2(number of neighbours). Both directions of a pair
    are joined by p + q - pq.
    """
    w = memberships(neighbours, steps)
    p = F.coalesce(F.sum(F.when(F.col("src") < F.col("dst"), F.col("weight"))), F.lit(0.0))
    q = F.coalesce(F.sum(F.when(F.col("src") > F.col("dst"), F.col("weight"))), F.lit(0.0))
    ends = w.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    return ends.agg((p + q - p * q).alias("weight"))


def memberships(neighbours: DataFrame, steps: int = 64) -> DataFrame:
    """(src, dst, weight) of the directed lists."""
    spread = neighbours.repartition(shuffle_width(neighbours.sparkSession), "src")  # bisection is heavy for its bytes
    lists = spread.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("distance", "dst"))).alias("ns"))  # k rows
    dist = F.transform("ns", lambda x: x["distance"])
    rho = F.coalesce(F.array_min(F.filter(dist, lambda d: d > 0)), F.lit(0.0))
    target = F.log2(F.size("ns").cast("double"))
    staged = lists.select("src", "ns", dist.alias("ds"), rho.alias("rho"), target.alias("target"))
    # sigma is handed over as an array element, so that it is worked out once per row and not per neighbour
    once = F.array(sigma(F.col("ds"), F.col("rho"), F.col("target"), steps))
    weighted = F.flatten(F.transform(once, lambda s: F.transform("ns", lambda n: F.struct(
        n["dst"].alias("dst"), _member(n["distance"], F.col("rho"), s).alias("weight")))))
    return staged.select("src", F.explode(weighted).alias("n")).select("src", "n.dst", "n.weight")


def _member(d: Column, rho: Column, s: Column) -> Column:
    return F.when(d <= rho, F.lit(1.0)).otherwise(F.exp(-(d - rho) / s))


def sigma(ds: Column, rho: Column, target: Column, steps: int = 64) -> Column:
    """Bisection for sigma: doubles while no upper end is known, then halves the interval."""

    def step(state: Column, _: Column) -> Column:
        total = F.aggregate(ds, F.lit(0.0), lambda s, d: s + _member(d, rho, state["mid"]))
        high = total > target
        lo = F.when(high, state["lo"]).otherwise(state["mid"])
        hi = F.when(high, state["mid"]).otherwise(state["hi"])
        mid = F.when(hi < 0, state["mid"] * 2).otherwise((lo + hi) / 2)
        return F.struct(lo.alias("lo"), hi.alias("hi"), mid.alias("mid"))

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(-1.0).alias("hi"), F.lit(1.0).alias("mid"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["mid"])


def pca_2d(vectors: DataFrame) -> DataFrame:
    """(id, x, y): centred projection on the two main axes; each axis points to its largest loading."""
    v = doubles(F.col("embedding"))
    model = PCA(k=2, inputCol="f", outputCol="p").fit(vectors.select(array_to_vector(v).alias("f")))
    axes = model.pc.toArray()
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), [0, 1]])
    flat = [dot(v, F.array(*[F.lit(float(a)) for a in axes[:, j]])) for j in (0, 1)]
    raw = vectors.select("id", flat[0].alias("x"), flat[1].alias("y"))
    mean = lambda c: raw.agg(F.avg(c)).scalar()
    return raw.select("id", (F.col("x") - mean("x")).alias("x"), (F.col("y") - mean("y")).alias("y"))


def curve_parameters(min_dist: float = MIN_DIST, spread: float = 1.0) -> tuple[float, float]:
    """(a, b) so that 1 / (1 + a d^2b) comes closest to 1 within min_dist and exp decay beyond it."""
    d = np.linspace(0, 3 * spread, 300)[1:]
    want = np.where(d < min_dist, 1.0, np.exp(-(d - min_dist) / spread))
    p = np.array([1.0, 1.0])
    for _ in range(100):
        power = d ** (2 * p[1])
        fit = 1 / (1 + p[0] * power)
        jac = np.stack([-(fit**2) * power, -(fit**2) * p[0] * power * 2 * np.log(d)], axis=1)
        p = p + 0.5 * np.linalg.lstsq(jac, want - fit, rcond=None)[0]
    return float(p[0]), float(p[1])


def layout_2d(
    start: DataFrame, graph: DataFrame, epochs: int = 30, min_dist: float = MIN_DIST, seed: int = SPLIT_SEED,
    negatives: int = 5,
) -> DataFrame:
    """(id, x, y): positions after `epochs` synchronous rounds of attraction along `graph` (a, b, weight)
    and repulsion from `negatives` nodes per node and round, which a keyed hash draws from a sample of at most SAMPLED nodes that
    all nodes of the round share.

    A round joins the links with the positions of both ends, sums per node, and writes the new positions: links with
    weights meet in one shuffle, and the sample is broadcast.
    """
    a, b = curve_parameters(min_dist)
    span = start.agg(F.max(F.greatest(F.abs("x"), F.abs("y"))).alias("m")).first()["m"] or 1.0
    place = settle(start.select("id", (F.col("x") * (10.0 / span)).alias("x"), (F.col("y") * (10.0 / span)).alias("y")))
    drawn = min(SAMPLED, place.count())
    wires = settle(graph.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")),
                                                  F.struct(F.col("b").alias("id"), F.col("a").alias("other")))).alias("e"),
                                "weight").select("e.id", "e.other", "weight"))
    clip = lambda c: F.greatest(F.least(c, F.lit(4.0)), F.lit(-4.0))
    dx, dy = F.col("x") - F.col("ox"), F.col("y") - F.col("oy")
    d2 = dx * dx + dy * dy
    pull = F.when(d2 > 0, -2.0 * a * b * F.pow(d2, b - 1) / (1 + a * F.pow(d2, b))).otherwise(F.lit(0.0)) * F.col("weight")
    push = 2.0 * b / ((0.001 + d2) * (1 + a * F.pow(d2, b)))
    for epoch in range(epochs):
        rate = FIRST_STEP * (1.0 - epoch / epochs)
        others = place.select(F.col("id").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"))
        pulls = wires.join(others, "other").join(place, "id").select("id", clip(pull * dx).alias("mx"), clip(pull * dy).alias("my"))
        draw = F.xxhash64(F.lit(seed), F.lit(epoch), "other")
        shared = others.orderBy(draw, "other").limit(drawn).withColumn("slot", F.row_number().over(W.orderBy(draw, "other")) - 1)
        slots = F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(seed), F.lit(epoch), "id", F.lit(t)), F.lit(drawn)).cast("int") for t in range(negatives)]))
        away = place.select("id", "x", "y", slots.alias("slot")).join(F.broadcast(shared), "slot").where("id <> other")
        pushes = away.select("id", clip(push * dx).alias("mx"), clip(push * dy).alias("my"))
        moves = pulls.unionByName(pushes).groupBy("id").agg(F.sum("mx").alias("mx"), F.sum("my").alias("my"))
        shift = lambda c: F.coalesce(clip(F.col(c)), F.lit(0.0)) * rate
        place = settle(place.join(moves, "id", "left").select(
            "id", (F.col("x") + shift("mx")).alias("x"), (F.col("y") + shift("my")).alias("y")), replaces=place)
    discard(wires)
    return place.select("id", F.col("x").cast("float").alias("x"), F.col("y").cast("float").alias("y"))


__all__ = ["curve_parameters", "fuzzy_graph", "knn", "layout_2d", "memberships", "pca_2d", "sigma"]
