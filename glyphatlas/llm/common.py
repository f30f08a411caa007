"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Word characters are everything but the ASCII blanks; bytes.split() cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"

MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) only; a null text is empty. Further columns, whatever their names, stay behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of doc_id as text, modulo `folds`, is `fold`; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def keep_ids(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of `docs` whose doc_id is (left_semi) or is not (left_anti) in `ids`; a null id equals a null id."""
    picked = ids.select(F.col("doc_id").alias("__picked")).distinct()
    return docs.join(picked, docs["doc_id"].eqNullSafe(picked["__picked"]), how)


def text_mark(text: str) -> Column:
    """A hash that tells texts of the same doc_id apart; a null text is empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def drop_marked(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id and text are not those of a row (doc_id, mark); null ids and repeated ids are told apart by their texts."""
    gone = marked.select(F.col("doc_id").alias("__gone"), F.col("mark").alias("__mark")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["__gone"]) & (text_mark("text") == gone["__mark"]), "left_anti")


def utf8(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in one piece, and the offset where each row begins (one more for the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=2)
def _power_table(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have, step = 1, base
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * np.uint64(step)
        have += more
        step = step * step % (1 << 64)
    return out


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    return _power_table(base, 1 << max(20, int(n - 1).bit_length()))[:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span; equal bytes have equal hashes, wherever they stand."""
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=run[1:])
    size = (end - start).astype(np.uint64)
    return mixed((run[end] - run[start]) * _powers(_BASE_INVERSE, len(data) + 1)[start] + size * MIX)


class Words:
    """The words of a batch of texts as arrays: `start`/`end` byte places, `row` of each word, `first` word of each
    row (one more for the end) and a 64-bit `hash` of each word's bytes, with A-Z lowered if asked."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        inside = ~_BLANK[data]
        edge = np.empty(len(data) + 1, bool)
        if len(data):
            edge[0], edge[-1] = inside[0], inside[-1]
            edge[1:-1] = inside[1:] != inside[:-1]
        else:
            edge[:] = False
        # a row's end also ends its last word
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        glued = np.flatnonzero(cut[1:-1] & inside[1:] & inside[:-1]) + 1 if len(data) > 1 else np.zeros(0, np.int64)
        places = np.flatnonzero(edge)
        self.start, self.end = places[::2], places[1::2]
        if len(glued):
            self.start = np.sort(np.concatenate([self.start, glued]))
            self.end = np.sort(np.concatenate([self.end, glued]))
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = span_hashes(_LOWER[data] if lower else data, self.start, self.end)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of every window of k words within a row, in order."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        out = self.hash[:n - k + 1].copy()
        for i in range(1, k):
            out = mixed(out * MIX + self.hash[i:n - k + 1 + i])
        same = self.row[:n - k + 1] == self.row[k - 1:]
        return self.row[:n - k + 1][same], out[same]


def in_pieces(batches: Iterable[pa.RecordBatch], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds at most `most` bytes of text, or a single row."""
    for batch in batches:
        _, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on `on` in which null equals null; the columns of `on` come from the left."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    test = F.lit(True)
    for c in on:
        test = test & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(renamed, test, how).drop(*[f"__r_{c}" for c in on])


def join_with_hot_keys(rows: DataFrame, table: DataFrame, on: list[str], count: str, share: int = 500) -> DataFrame:
    """Inner equi-join of `rows` with `table`, which has one row per key and, in `count`, how many of `rows` hold it.

    Fewer than `share` keys can each hold more than one part in `share` of all rows: these are broadcast, and their rows are not
    moved. No key that is left holds more than that part, so the shuffle of the rest is even.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) * share > total
    often = F.broadcast(table.where(hot))
    rest = rows.join(often.select(*on), on, "left_anti").join(table.where(~hot), on)
    return rows.join(often, on).unionByName(rest)
