"""Directly addressable codes for token ids: random access to any token without decoding a block.

An id is split into chunks of `CHUNK` bits. Level 0 holds the lowest chunk of every id and a bitmap that says
whether the id goes on; level 1 holds the next chunk of those that do, and so on. The place of an id on the
next level is the number of ones before it in the bitmap (its rank), which a directory with one count for
every `STRIDE` bits and a popcount over at most one stride give.

File format, little-endian: magic "DAC1", uint32 number of levels, uint64 number of ids; then per level
uint64 number of entries, uint8 chunks, uint64 bitmap words, uint64 directory counts.

The files are Spark tables of such blobs, so any store that Spark writes to will do and a lost task is
written again: `part` and `block` number them in ascending doc_id order, doc_ids and lengths list the
documents of a blob. A document never crosses blobs.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphatlas.llm import tokens
from glyphatlas.llm.common import crc32, doc_texts, in_pieces, utf8
from glyphatlas.operators.ranking import running_totals
from glyphatlas.session import ensure_checkpoint_dir, shuffle_width

CHUNK = 8
STRIDE = 512
MAGIC = b"DAC1"
END_ID = 2
BLOB_TOKENS = 1 << 20
# Bytes of text that a task encodes at a time, whole texts at least; the arrays of a piece are some fifty times its size.
PIECE_BYTES = 1 << 19
FILE_SCHEMA = "part int, block int, doc_ids array<long>, lengths array<long>, n_tokens long, payload binary"


def encode(ids: np.ndarray) -> bytes:
    """The blob of `ids` (unsigned, up to 64 bits)."""
    left = np.asarray(ids, np.uint64)
    levels = []
    while True:
        more = left >> np.uint64(CHUNK)
        goes_on = more > 0
        levels.append(((left & np.uint64(255)).astype(np.uint8), goes_on))
        if not goes_on.any():
            break
        left = more[goes_on]
    out = [MAGIC, struct.pack("<IQ", len(levels), len(ids))]
    for chunks, goes_on in levels:
        words = np.zeros(-(-len(chunks) // STRIDE) * (STRIDE // 64), np.uint64)
        packed = np.packbits(goes_on, bitorder="little")
        words.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(words).reshape(-1, STRIDE // 64).sum(axis=1, dtype=np.uint64)
        out += [struct.pack("<Q", len(chunks)), chunks.tobytes(), words.tobytes(), (np.cumsum(ones) - ones).astype(np.uint64).tobytes()]
    return b"".join(out)


class Reader:
    """Random access to the ids of a blob."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a blob of directly addressable codes")
        n_levels, self.n = struct.unpack_from("<IQ", blob, 4)
        at = 16
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", blob, at)
            at += 8
            strides = -(-n // STRIDE)
            chunks = np.frombuffer(blob, np.uint8, n, at)
            words = np.frombuffer(blob, np.uint8, strides * STRIDE // 8, at + n)
            ranks = np.frombuffer(blob, np.uint8, strides * 8, at + n + strides * STRIDE // 8).view("<u8") if strides else np.zeros(0, "<u8")
            at += n + strides * (STRIDE // 8 + 8)
            self.levels.append((chunks, words, ranks))

    def _rank(self, level: int, i: int) -> int:
        """Ones before bit i."""
        _, bits, ranks = self.levels[level]
        if i // STRIDE == len(ranks):
            i, extra = i - 1, 1
            extra = int(bits[i // 8] >> (i % 8) & 1)
        else:
            extra = 0
        first = i // STRIDE * (STRIDE // 8)
        whole = int(np.bitwise_count(bits[first:i // 8]).sum())
        return int(ranks[i // STRIDE]) + whole + int(bits[i // 8] & ((1 << (i % 8)) - 1)).bit_count() + extra

    def access(self, i: int) -> int:
        """The id at place i, from one chunk a level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, level = 0, 0
        while True:
            chunks, bits, _ = self.levels[level]
            value |= int(chunks[i]) << (CHUNK * level)
            if not bits[i // 8] >> (i % 8) & 1:
                return value
            i = self._rank(level, i)
            level += 1

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids at the places start to end, end excluded; only their chunks are read."""
        out = np.zeros(max(0, end - start), np.uint64)
        where = np.arange(len(out))
        for level, (chunks, bits, _) in enumerate(self.levels):
            if start >= end:
                break
            out[where] |= chunks[start:end].astype(np.uint64) << np.uint64(CHUNK * level)
            goes_on = np.unpackbits(bits[start // 8:-(-end // 8)], bitorder="little")[start % 8:start % 8 + end - start].astype(bool)
            if level + 1 < len(self.levels):
                begin = self._rank(level, start)
                where = where[goes_on]
                start, end = begin, begin + len(where)
        return out


def blobs(batches: Iterator[pa.RecordBatch], vocabulary: str = tokens.BYTE_BPE, end_id: int = END_ID) -> Iterator[pa.RecordBatch]:
    """The blobs of a part from its (doc_id, text, part) rows in order."""
    path = tokens.vocabulary(vocabulary)
    ids: list[np.ndarray] = []
    docs: list[pa.Array] = []
    sizes: list[np.ndarray] = []
    part, block = None, 0

    def blob() -> pa.RecordBatch:
        length, flat = np.concatenate(sizes), np.concatenate(ids)
        names = pa.chunked_array(docs).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([names.to_pylist()], pa.list_(pa.int64())),
             pa.array([length], pa.list_(pa.int64())), pa.array([len(flat)], pa.int64()), pa.array([encode(flat)], pa.binary())],
            ["part", "block", "doc_ids", "lengths", "n_tokens", "payload"])

    for batch in in_pieces(batches, PIECE_BYTES):
        part = batch.column(2)[0].as_py()
        flat, n = tokens.byte_bpe_ids(path, *utf8(batch.column(1)))
        ends = np.cumsum(n)
        ids.append(np.insert(flat.astype(np.uint32), ends, end_id))
        sizes.append(n + 1)
        docs.append(batch.column(0))
        if sum(map(len, ids)) >= BLOB_TOKENS:
            yield blob()
            ids, docs, sizes, block = [], [], [], block + 1
    if ids:
        yield blob()


def write_codes(docs: DataFrame, path: str, vocabulary: str = tokens.BYTE_BPE, end_id: int = END_ID) -> None:
    """Encode every whole text, append `end_id`, and write the blobs to `path` in ascending doc_id order.

    Documents are dealt out in ranges of doc_id before they are encoded; a null doc_id comes first, a null text is
    empty, rows with equal doc_id stand beside each other. An empty table gives no blob.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return blobs(batches, vocabulary, end_id)

    laid = doc_texts(docs).repartitionByRange(shuffle_width(docs.sparkSession), F.col("doc_id").asc_nulls_first())
    laid = laid.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    laid.withColumn("part", F.spark_partition_id()).mapInArrow(code, FILE_SCHEMA).write.parquet(path)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    files = spark.read.parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = Reader(row["payload"])
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                sums = [crc32(reader.ids(int(s), int(e)).astype("<u4").tobytes()) for s, e in zip(starts, ends, strict=True)]
                n = len(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(starts, pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(sums, pa.int64())],
                    ["part", "block", "doc_id", "inner", "n_tokens", "ids_crc32"])

    # one narrow row per blob of a million ids
    before = running_totals(files.select("part", "block", "n_tokens"), [F.col("part"), F.col("block")], {"before": F.col("n_tokens")})
    narrow = files.select("part", "block", "doc_ids", "lengths", "payload")
    rows = narrow.mapInArrow(decode, "part int, block int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return rows.join(before.select("part", "block", "before"), ["part", "block"]).select(
        "doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def scratch(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
