"""Ranking of targets among all vectors.

Queries lie in numbered groups whose vectors take about CHUNK_BYTES; every group is one task, which reads all vectors as a stream: once to pick those of its
pairs, once to count. All pairs of a source are in one group, unless they are very many, so a source is compared with a vector once. Similarities are
worked out in single precision, around a centre, and with a bound of their error; only those too near to a target to tell are worked out again in double precision. They
are never rows, nothing passes the driver, and a node with very many edges makes no large group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphatlas.functions.vectors import doubles
from glyphatlas.session import settle

CHUNK_BYTES = 256 << 20
# Groups of queries at least; over all values of `by` twice as many, so that tasks of equal size end at about the same time.
LEAST_GROUPS = 16
SIM_DIGITS = 9
# Similarities that a task holds at a time.
CELLS = 1 << 21
# Similarities of a product in single precision, and vectors of one: with few, few pairs have one among them that single precision cannot tell from the target.
TILE = 1 << 19
COLUMNS = 2048
# Pairs that a task looks up at a time.
AT_ONCE = 4096
# Pairs of a source that may lie in one group; those of a source with more are dealt to several.
MOST_PAIRS = 1 << 16
# Sources with more pairs than this have their similarities sorted once, instead of compared with the target of every pair.
SORTED_FROM = 4
# The largest relative error of rounding to single precision.
HALF_ULP = 2.0**-24


def hits_at_k(vectors: DataFrame, pairs: DataFrame, ks=(10, 100), by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., n_pairs, hits_at_k..., mrr) of finding `dst` among all other vectors, nearest to `src` first.

    Vectors have length 1. The rank is 1 plus the number of vectors strictly nearer than the target; the
    source itself does not count. Similarities are compared after rounding.
    """
    ranks = target_ranks(vectors, pairs, by)
    n = F.count(F.lit(1))
    return ranks.groupBy(*by).agg(
        n.alias("n_pairs"),
        *[(F.count_if(F.col("rank") <= k) / n).alias(f"hits_at_{k}") for k in ks],
        F.avg(1 / F.col("rank")).alias("mrr"),
    )


def target_ranks(vectors: DataFrame, pairs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., src, dst, rank) for every pair."""
    points = vectors.select(*by, "id", doubles(F.col("embedding")).alias("v"))
    asked = settle(pairs.select("src", "dst"))
    width = (points.agg(F.max(F.size("v"))).first()[0] or 0) + 4
    each = settle(points.select(*by).distinct().withColumn("_e", F.row_number().over(W.orderBy(*by)) - 1)) if by else None  # few rows
    n_each = max(1, each.count()) if by else 1
    groups = max(1, -(-LEAST_GROUPS * (2 if n_each > 1 else 1) // n_each), -(-asked.count() * 8 * width // CHUNK_BYTES))
    often = settle(asked.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / F.lit(MOST_PAIRS)).alias("_often")).where("_often > 1"))
    part = F.pmod(F.xxhash64("dst"), F.coalesce("_often", F.lit(1)))
    dealt_out = asked.join(often, "src", "left").select("src", "dst", F.pmod(F.xxhash64("src", part), F.lit(groups)).cast("int").alias("_q"))
    empty = F.lit(None).cast("array<double>")
    of_all = dealt_out.crossJoin(F.broadcast(each)) if by else dealt_out.withColumn("_e", F.lit(0))  # a row for every value of `by`
    place = (F.col("_e") * groups + F.col("_q")).cast("int").alias("_q")
    questions = of_all.select(*by, place, F.lit(0).alias("_kind"), F.col("src").alias("id"), "dst", empty.alias("v"))
    # every group gets the vectors twice: to pick those of its pairs, and to compare
    kind = points.schema["id"].dataType
    if by:
        same = [F.col(f"p.{c}").eqNullSafe(F.col(f"e.{c}")) for c in by]
        numbered = points.alias("p").join(F.broadcast(each.alias("e")), same).select(*[F.col(f"p.{c}") for c in by], "id", "v", "_e")
    else:
        numbered = points.withColumn("_e", F.lit(0))
    sent = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(q).alias("q")) for q in range(groups) for k in (1, 2)]))
    told = numbered.select(*by, "id", "v", "_e", sent.alias("e")).select(
        *by, (F.col("_e") * groups + F.col("e.q")).cast("int").alias("_q"), F.col("e.k").alias("_kind"), "id", F.lit(None).cast(kind).alias("dst"), "v")
    dealt = questions.select(*by, "_q", "_kind", F.col("id").cast(kind).alias("id"), F.col("dst").cast(kind).alias("dst"), "v").unionByName(told)
    # a partition for every group
    dealt = dealt.repartitionById(n_each * groups, F.col("_q")).sortWithinPartitions("_q", "_kind")
    schema = T.StructType([*[points.schema[c] for c in by], T.StructField("src", kind), T.StructField("dst", kind), T.StructField("above", T.LongType())])
    counted = dealt.mapInArrow(_ranks(len(by)), schema)
    return counted.groupBy(*by, "src", "dst").agg((F.sum("above") + 1).alias("rank"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), -1)


def _runs(table: pa.Table, keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """The slices of a table sorted by its first `keys` columns that share their values."""
    cut = np.zeros(max(0, table.num_rows - 1), bool)
    for i in range(keys):
        codes = table.column(i).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        cut |= codes[1:] != codes[:-1]
    edges = [0, *(np.flatnonzero(cut) + 1).tolist(), table.num_rows]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            yield tuple(table.column(i)[a].as_py() for i in range(keys)), table.slice(a, b - a)


class _Group:
    """The pairs of a group, the vectors of their ends, and how many vectors so far are nearer than the targets."""

    def __init__(self) -> None:
        self.pairs: list[pa.Table] = []
        self.ends: list[tuple[np.ndarray, np.ndarray]] = []
        self.named: pa.Array | None = None
        self.ready = False

    def add(self, kind: int, rows: pa.Table) -> None:
        if kind == 0:
            self.pairs.append(rows.select(["id", "dst"]))
        elif not self.pairs:
            return
        elif kind == 1:
            if self.named is None:
                pairs = pa.concat_tables(self.pairs)
                self.named = pa.chunked_array([*pairs.column("id").chunks, *pairs.column("dst").chunks]).unique().drop_null()
            held = rows.filter(pc.is_in(rows.column("id"), value_set=self.named))
            if held.num_rows:
                self.ends.append((held.column("id").to_numpy(), _matrix(held.column("v"))))
        elif self.ends:
            self._prepare()
            self._count(rows)

    def _prepare(self) -> None:
        import pandas as pd

        if self.ready:
            return
        self.ready = True
        ids, v = np.concatenate([i for i, _ in self.ends]), np.concatenate([v for _, v in self.ends])
        self.ends = self.ends[:1]
        pairs = pa.concat_tables(self.pairs).to_pandas().dropna()
        spots = pd.DataFrame({"id": ids, "_s": np.arange(len(ids))})
        both = pairs.merge(spots, on="id").merge(spots.rename(columns={"id": "dst", "_s": "_t"}), on="dst")
        self.pairs = self.pairs[:1]
        # sources with most pairs come first, and the pairs of a source one after the other
        spot, code, often = np.unique(both["_s"].to_numpy(), return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        self.often = often[order]
        self.first = np.concatenate([[0], np.cumsum(self.often)])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        both = both.iloc[np.argsort(place[code], kind="stable")]
        self.src, self.dst, to = both["id"].to_numpy(), both["dst"].to_numpy(), both["_t"].to_numpy()
        self.at = np.repeat(np.arange(len(order)), self.often)
        self.q = v[spot[order]]
        self.above = np.zeros(len(both), np.int64)
        self.target = np.zeros(len(both))
        for a in range(0, len(both), AT_ONCE):
            part = slice(a, a + AT_ONCE)
            self.target[part] = _rounded(self.q[self.at[part]], v[to[part]])
        sound = v[np.isfinite(v).all(axis=1)]  # what is not a number is nearer than nothing
        self.centre = sound.mean(axis=0) if len(sound) else np.zeros(v.shape[1])
        # q.v = (q - c).(v - c) + c.(v - c) + q.c: where all vectors are alike, what tells them apart is not lost in rounding
        away = self.q - self.centre
        self.q32 = np.column_stack([away, np.ones(len(away))]).astype(np.float32)
        self.length = np.sqrt(np.einsum("ij,ij->i", away, away))
        # the first two terms above `limit`, which is a number, make a similarity that is rounded to more than the target
        self.limit = self.target + 0.5 * 10.0**-SIM_DIGITS - (self.q @ self.centre)[self.at]
        self.tile = np.empty(TILE + COLUMNS, np.float32)
        # the pairs by the id of their source
        self.by_id = np.argsort(self.src, kind="stable")
        self.sorted_ids = self.src[self.by_id]

    def _count(self, rows: pa.Table) -> None:
        if not len(self.src):
            return
        v = _matrix(rows.column("v"))
        if not np.isfinite(v).all():  # what is not a number is above nothing; what is infinite has no bound
            self._count_plainly(rows)
            return
        moved = v - self.centre
        size = np.sqrt(np.einsum("ij,ij->i", moved, moved))
        along = moved @ self.centre
        # vectors at about the same distance from the centre share a bound
        scale = np.frexp(size)[1] // 2
        for s in np.unique(scale):
            chosen = np.flatnonzero(scale == s)
            self._count_near(v[chosen], moved[chosen], along[chosen], float(size[chosen].max()))
        # the source itself does not count
        column = rows.column("id").combine_chunks()
        named = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
        ids = column.drop_null().to_numpy(zero_copy_only=False)
        begin, end = np.searchsorted(self.sorted_ids, ids, "left"), np.searchsorted(self.sorted_ids, ids, "right")
        for i in np.flatnonzero(end > begin):
            own = self.by_id[begin[i] : end[i]]
            x = np.broadcast_to(v[named[i]], (len(own), v.shape[1]))
            self.above[own] -= _rounded(self.q[self.at[own]], x) > self.target[own]

    def _count_near(self, v: np.ndarray, moved: np.ndarray, along: np.ndarray, size: float) -> None:
        """Add the vectors `v` that are nearer than the targets; `moved` are the same around the centre, at most `size` long, and `along` their products with it."""
        # rounding of both sides and of every step of the sum, of the limits, and of the double precision that the bound starts from
        terms = size * self.length[self.at] + np.abs(along).max()
        slack = HALF_ULP * (1.02 * (v.shape[1] + 6) * terms + 4 * np.abs(self.limit)) + 1e-13
        low, high = (self.limit - slack).astype(np.float32), (self.limit + slack).astype(np.float32)
        single = np.column_stack([moved, along]).astype(np.float32)
        for at in range(0, len(v), COLUMNS):
            self._count_tile(v[at : at + COLUMNS], single[at : at + COLUMNS], low, high)

    def _count_tile(self, v: np.ndarray, single: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        n = len(v)
        step = max(1, TILE // n)
        for a in range(0, len(self.q), step):
            b = min(a + step, len(self.q))
            sims = np.matmul(self.q32[a:b], single.T, out=self.tile[: (b - a) * n].reshape(b - a, n))
            # the sources with most pairs lead
            many = a + int(np.searchsorted(-self.often[a:b], -SORTED_FROM, "left"))
            lines = np.sort(sims[: many - a], axis=1).ravel()
            for f in range(int(self.first[a]), int(self.first[many]), TILE):
                pairs = np.arange(f, min(f + TILE, int(self.first[many])))
                row = self.at[pairs] - a
                found = _up_to(lines, row * n, n, high[pairs])
                self.above[pairs] += n - found
                close = np.flatnonzero((found > 0) & (lines[np.maximum(row * n + found - 1, 0)] > low[pairs]))
                for c in range(0, len(close), step):
                    some = close[c : c + step]
                    self._settle(pairs[some], sims[row[some]], v, low, high)
            for k in range(int(self.often[many]) if many < b else 0):
                last = a + int(np.searchsorted(-self.often[a:b], -k, "left"))
                pairs, some = self.first[many:last] + k, sims[many - a : last - a]
                sure, maybe = _true(some > high[pairs, None]), _true(some > low[pairs, None])
                self.above[pairs] += sure
                close = np.flatnonzero(maybe > sure)
                if len(close):
                    self._settle(pairs[close], some[close], v, low, high)

    def _settle(self, pairs: np.ndarray, sims: np.ndarray, v: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Add the vectors whose similarity single precision cannot tell from the targets of the pairs, a row each."""
        row, col = np.divmod(np.flatnonzero((sims > low[pairs, None]) & (sims <= high[pairs, None])), len(v))
        for a in range(0, len(row), 8 * AT_ONCE):
            mine, other = pairs[row[a : a + 8 * AT_ONCE]], col[a : a + 8 * AT_ONCE]
            nearer = _rounded(self.q[self.at[mine]], v[other]) > self.target[mine]
            np.add.at(self.above, mine[nearer], 1)

    def _count_plainly(self, rows: pa.Table) -> None:
        for a in range(0, len(self.src), AT_ONCE):
            spot = slice(a, a + AT_ONCE)
            x = self.q[self.at[spot]]
            sv = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            queries = pa.table({"src": pa.array(self.src[spot], rows.schema.field("id").type), "sv": sv, "target": self.target[spot]})
            self.above[spot] += _count_above(queries, rows).column("above").to_numpy()


def _rounded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.round(np.einsum("ij,ij->i", a, b), SIM_DIGITS)


def _up_to(lines: np.ndarray, begin: np.ndarray, n: int, most: np.ndarray) -> np.ndarray:
    """How many of the `n` sorted numbers from each place of `begin` on are at most `most`."""
    found = np.zeros(len(begin), np.int64)
    for bit in reversed(range(n.bit_length())):
        further = found + (1 << bit)
        good = further <= n
        good &= lines[begin + np.where(good, further, 1) - 1] <= most
        found[good] = further[good]
    return found


def _true(mask: np.ndarray) -> np.ndarray:
    """How many of each row are true; eight are added at a time."""
    whole = mask.shape[1] // 8 * 8
    found = mask[:, whole:].sum(axis=1)
    words = np.ascontiguousarray(mask[:, :whole]).view(np.uint64)
    for a in range(0, words.shape[1], 255):  # no byte overflows
        found += words[:, a : a + 255].sum(axis=1).view(np.uint8).reshape(len(mask), 8).sum(axis=1, dtype=np.int64)
    return found


def _count_above(queries: pa.Table, corpus: pa.Table) -> pa.Table:
    """For every (src, ..., sv, target), how many of the vectors (id, v) are nearer than its target."""
    above = np.zeros(queries.num_rows, np.int64)
    if queries.num_rows and corpus.num_rows:
        sv, target, src = _matrix(queries.column("sv")), queries.column("target").to_numpy(), queries.column("src").to_numpy()
        v, ids = _matrix(corpus.column("v")), corpus.column("id").to_numpy()
        step = max(1, CELLS // len(ids))
        for at in range(0, len(above), step):
            spot = slice(at, at + step)
            nearer = np.round(sv[spot] @ v.T, SIM_DIGITS) > target[spot][:, None]
            above[spot] = (nearer & (src[spot][:, None] != ids[None, :])).sum(axis=1)
    kept = [c for c in queries.column_names if c not in ("sv", "target")]
    return queries.select(kept).append_column("above", pa.array(above))


def _ranks(n_by: int):
    """For sorted (by..., group, kind, id, dst, v) rows: (by..., src, dst, above), how many vectors are nearer to `src` than `dst` is."""

    def answer(key: tuple, group: _Group, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if group.ready and len(group.src):
            id_type = schema.field("id").type
            named = [pa.array([key[i]] * len(group.src), schema.field(i).type) for i in range(n_by)]
            arrays = [*named, pa.array(group.src, id_type), pa.array(group.dst, id_type), pa.array(np.where(np.isfinite(group.limit), group.above, 0))]
            yield pa.RecordBatch.from_arrays(arrays, [*schema.names[:n_by], "src", "dst", "above"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, group, schema = None, None, None
        for batch in batches:
            schema = batch.schema
            for key, rows in _runs(pa.Table.from_batches([batch]), n_by + 2):
                if group is None or key[:-1] != last:
                    if group is not None:
                        yield from answer(last, group, schema)
                    last, group = key[:-1], _Group()
                group.add(key[-1], rows)
        if group is not None:
            yield from answer(last, group, schema)

    return run
