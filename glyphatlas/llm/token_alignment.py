"""Alignment of the ids that two tokenizers give to the same text.

Both id lists of a text end their tokens at byte offsets. Each list becomes a dictionary from end offset to token index; the
intersection of the two key sets, sorted, holds the offsets where both end, and slices both id lists into groups. The tokens of a
slice whose ends agree are its links. Texts are walked in windows of `WINDOW` bytes, so that the dictionaries stay
small however long a text is.

The corpus then says how often each pair of ids is linked, and which partner an id of the second vocabulary has most often. Of two
tokens that end together the shorter one is a suffix of the longer one, so there are no more different pairs than suffixes of vocabulary
entries that are entries of the other vocabulary (`most_pairs`), however large the corpus is: only that table travels to the tasks.

Defined results: null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens, no links and
an empty digest. Rows are never joined by doc_id, so null and repeated ids keep their own results. Strings of special tokens
inside texts are plain text. Further columns stay behind. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphatlas.llm import tokens
from glyphatlas.llm.common import doc_texts, in_pieces, utf8
from glyphatlas.llm.token_codes import scratch

WINDOW = 1 << 18
PIECE = 1 << 20
B_IDS = 1 << 20
_MARK = tokens.MARK.encode()


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, window: int = WINDOW) -> Iterator[tuple[list[int], list[int]]]:
    """For each window, how many tokens of either list end up to each offset where both end, in order of the offsets."""
    low = done_a = done_b = 0
    last = int(ends_a[-1]) if len(ends_a) else 0
    while low < last:
        high = low + window
        to_a, to_b = np.searchsorted(ends_a, high, "right"), np.searchsorted(ends_b, high, "right")
        index_a = dict(zip(ends_a[done_a:to_a].tolist(), range(done_a + 1, to_a + 1), strict=True))
        index_b = dict(zip(ends_b[done_b:to_b].tolist(), range(done_b + 1, to_b + 1), strict=True))
        keys = sorted(index_a.keys() & index_b.keys())
        yield [index_a[e] for e in keys], [index_b[e] for e in keys]
        low, done_a, done_b = high, to_a, to_b


def groups(ids_a: list, ids_b: list, ends_a: np.ndarray, ends_b: np.ndarray, window: int = WINDOW) -> Iterator[tuple[list, list]]:
    """The slices of both id lists between the offsets where both end."""
    at_a = at_b = 0
    for to_a, to_b in common_ends(ends_a, ends_b, window):
        for i, j in zip(to_a, to_b, strict=True):
            yield ids_a[at_a:i], ids_b[at_b:j]
            at_a, at_b = i, j


def links(group_a: list, group_b: list) -> tuple:
    """The pair of a slice's tokens that end together: both lists of a slice meet at its end and nowhere before."""
    return group_a[-1], group_b[-1]


def most_pairs(path_a: str, path_b: str) -> int:
    """No corpus can link more different pairs of ids."""
    held_a, held_b = tokens.byte_bpe_bytes(path_a), tokens.piece_bytes(path_b)

    def suffixes(entries: tuple[bytes, ...], others: tuple[bytes, ...]) -> int:
        many: dict[bytes, int] = {}
        for o in others:
            many[o] = many.get(o, 0) + 1
        return sum(many.get(e[i:], 0) for e in entries for i in range(len(e)))

    return suffixes(held_a, held_b) + suffixes(held_b, held_a)


def _ids(path_a: str, path_b: str, column: pa.Array) -> list[tuple[np.ndarray, ...]]:
    """(ids, ids per row, offset in its text where each ends) of both tokenizers over a space and each text; rows that either of
    them does not give back have none."""
    data, offsets = utf8(column)
    raw = data.tobytes()
    size = np.diff(offsets)
    usable = size > 0
    at = raw.find(_MARK)
    while at >= 0:  # the mark of a blank itself never comes back as it was
        row = int(np.searchsorted(offsets, at, "right")) - 1
        usable[row] = False
        at = raw.find(_MARK, int(offsets[row + 1]))
    text = data[np.repeat(usable, size)]
    length = np.where(usable, size, 0)
    text = np.insert(text, (np.cumsum(length) - length)[usable], 32)
    length = length + usable
    places = np.concatenate([[0], np.cumsum(length)])
    read = []
    whole = usable
    for ids, n, width in (
        (*tokens.byte_bpe_ids(path_a, text, places, plain=True), _widths(tokens.byte_bpe_bytes, path_a)),
        (*tokens.spaced_piece_ids(path_b, text, places), _widths(tokens.piece_bytes, path_b)),
    ):
        ends = np.cumsum(width[ids])
        before = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n)])]
        whole = whole & (np.diff(before) == length)
        read.append((ids.astype(np.int64), n, ends - np.repeat(before[:-1], n)))
    return [(ids[np.repeat(whole, n)], np.where(whole, n, 0), ends[np.repeat(whole, n)]) for ids, n, ends in read]


@functools.lru_cache(maxsize=4)
def _widths(entries: Callable[[str], tuple[bytes, ...]], path: str) -> np.ndarray:
    return np.array([len(e) for e in entries(path)], np.int64)


@functools.lru_cache(maxsize=4)
def _names(n_a: int, n_b: int) -> pa.Array:
    """Every id as text with what may follow it: `,` and `|` for the first vocabulary, `,`, `;` and nothing for the second."""
    return pa.array([f"{i}{s}" for i in range(n_a) for s in ",|"] + [f"{i}{s}" for i in range(n_b) for s in (",", ";", "")], pa.large_string())


def _written(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, last: np.ndarray, n_ids: tuple[int, int]) -> pa.Array:
    """The ids of all groups, group after group, as texts with their separators. `cut_a` and `cut_b` say where the groups end,
    `last` which groups end a text."""
    size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    code_a = ids_a * 2
    code_a[cut_a - 1] += 1
    code_b = n_ids[0] * 2 + ids_b * 3
    code_b[cut_b - 1] += 1 + last
    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    codes[np.arange(len(ids_a)) + np.repeat(cut_b - size_b, size_a)] = code_a
    codes[np.arange(len(ids_b)) + np.repeat(cut_a, size_b)] = code_b
    return _names(*n_ids).take(pa.array(codes))


def align(docs: DataFrame, vocabulary_a: str = tokens.BYTE_BPE, vocabulary_b: str = tokens.PIECE_BPE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) for every row: `pairs` are the different linked pairs of ids,
    a * B_IDS + b, and `times` how often the text links them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path_a, path_b = tokens.vocabulary(vocabulary_a), tokens.vocabulary(vocabulary_b)
        n_ids = len(tokens.byte_bpe_bytes(path_a)), len(tokens.piece_bytes(path_b))
        for batch in in_pieces(batches, PIECE):
            (ids_a, n_a, ends_a), (ids_b, n_b, ends_b) = _ids(path_a, path_b, batch.column(1))
            stops_a, stops_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
            cut_a, cut_b, n_groups = [], [], np.zeros(batch.num_rows, np.int64)
            for r in np.flatnonzero(n_a):
                at_a, at_b = int(stops_a[r]), int(stops_b[r])
                for to_a, to_b in common_ends(ends_a[at_a:stops_a[r + 1]], ends_b[at_b:stops_b[r + 1]]):
                    cut_a.append(np.array(to_a, np.int64) + at_a)
                    cut_b.append(np.array(to_b, np.int64) + at_b)
                    n_groups[r] += len(to_a)
            none = np.zeros(0, np.int64)
            cut_a, cut_b = np.concatenate([none, *cut_a]), np.concatenate([none, *cut_b])
            row = np.repeat(np.arange(batch.num_rows), n_groups)
            last = np.diff(row, append=-1) != 0
            written = _written(ids_a, ids_b, cut_a, cut_b, last, n_ids)
            ends = np.frombuffer(written.buffers()[1], np.int64)[stops_a + stops_b]
            held = memoryview(written.buffers()[2] or b"")
            digests = [hashlib.sha256(held[a:b]).hexdigest() if a < b else "" for a, b in itertools.pairwise(ends.tolist())]
            # the link of a slice: its two tokens that end where it ends
            linked, times = np.unique((row * B_IDS + ids_a[cut_a - 1]) * B_IDS + ids_b[cut_b - 1], return_counts=True)
            own = np.searchsorted(linked // (B_IDS * B_IDS), np.arange(batch.num_rows + 1))
            offsets = pa.array(own.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_groups), pa.array(digests, pa.string()),
                 pa.ListArray.from_arrays(offsets, pa.array(linked % (B_IDS * B_IDS))), pa.ListArray.from_arrays(offsets, pa.array(times))],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return doc_texts(docs).mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, b, n, best): how often the corpus links each pair, and whether no pair with the same b is linked more often."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n"))
    b = F.col("pair").bitwiseAND(F.lit(B_IDS - 1))
    named = counts.select("pair", F.shiftright("pair", 20).alias("a"), b.alias("b"), "n")
    most = named.groupBy("b").agg(F.max("n").alias("most"))
    return named.join(most, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(docs: DataFrame, vocabulary_a: str = tokens.BYTE_BPE, vocabulary_b: str = tokens.PIECE_BPE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of `docs`."""
    spark = docs.sparkSession
    place = scratch(spark, "aligned")
    align(docs, vocabulary_a, vocabulary_b).write.parquet(place)
    aligned = spark.read.parquet(place)
    bound = most_pairs(tokens.vocabulary(vocabulary_a), tokens.vocabulary(vocabulary_b))
    counts = pair_counts(aligned).select("pair", "n", "best").toArrow()
    if counts.num_rows > bound:
        raise ValueError(f"{counts.num_rows} pairs of ids, but the vocabularies allow {bound}")
    counts = counts.sort_by("pair")
    table = spark.sparkContext.broadcast(tuple(counts.column(c).to_numpy() for c in ("pair", "n", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = table.value
        for batch in batches:
            pairs, times = batch.column(6), batch.column(7)
            flat, many = pairs.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.searchsorted(pair, flat)
            ends = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())])
            total = np.concatenate([[0], np.cumsum(n[at] * many)])
            most = np.concatenate([[0], np.cumsum(best[at] * many)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(np.diff(most[ends])), pa.array(np.diff(total[ends])), batch.column(5)],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return aligned.mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
