"""Benchmark decontamination by greedy string tiling with running Karp-Rabin hashes.

1. Seeds: windows of `MIN_TILE` words of the benchmark, kept as sorted hashes. Every whole text looks up its own windows; an
   item that shares one becomes a candidate of the document.
2. Tiling: for each candidate, the longest match of words not yet marked on either side is found by Karp-Rabin hashes of
   windows (a binary search over the length, since every part of a match is a match), all matches of that length
   are marked from left to right, and so on down to `MIN_TILE` words. Passages in another order are tiled all the same.
3. A document is contaminated by an item if tiles cover `COVERAGE` of its words, or if one tile has `PASSAGE` words.

Documents stay where they are. The benchmark is read in blocks of at most `BLOCK_WORDS` words, each shipped to the
tasks, one pass over the documents per block: what is shipped has a bound and any size of benchmark is covered.

Words are lowered and lose ASCII punctuation at their ends. Null or empty texts match nothing; items of fewer than
`MIN_TILE` words have no seeds and match nothing; repeated items and documents are reported each. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphatlas.llm.common import MIX, Words, doc_texts, drop_marked, in_pieces, mixed, text_mark, utf8
from glyphatlas.llm.mixing import n_words

MIN_TILE = 5
COVERAGE = 0.8
PASSAGE = 50
BLOCK_WORDS = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PUNCTUATION = np.isin(np.arange(256), [ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"])


class BareWords(Words):
    """Words without ASCII punctuation at their ends; words of punctuation alone are left out."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        bare = data.copy()
        # punctuation beside a blank, an edge or more such punctuation is blank
        mark = _PUNCTUATION[data]
        body = np.flatnonzero(~mark & ~np.isin(data, [32, 9, 10, 11, 12, 13]))
        gap = np.isin(data, [32, 9, 10, 11, 12, 13])
        inner = np.zeros(len(data), bool)
        if len(body) > 1:
            stops = np.concatenate([[0], np.cumsum(gap)])
            row_cut = np.zeros(len(data) + 1, np.int64)
            np.add.at(row_cut, offsets, 1)
            cuts = np.cumsum(row_cut)
            left, right = body[:-1], body[1:]
            glued = (right > left + 1) & (stops[right] == stops[left]) & (cuts[right] == cuts[left])
            change = np.zeros(len(data) + 1, np.int64)
            np.add.at(change, left[glued] + 1, 1)
            np.add.at(change, right[glued], -1)
            inner = np.cumsum(change[:-1]) > 0
        bare[mark & ~inner] = 32
        super().__init__(bare, offsets)


class Windows:
    """Karp-Rabin hashes of any window of a sequence of word hashes."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        back = np.full(n + 1, _INVERSE, np.uint64)
        back[0] = 1
        self.back = np.multiply.accumulate(back)
        self.run = np.zeros(n + 1, np.uint64)
        np.cumsum(words * np.multiply.accumulate(power)[:n], out=self.run[1:])

    def of(self, size: int, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of the windows of `size` words without a marked one. free: running number of unmarked words."""
        last = len(self.run) - size
        if last <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        start = np.flatnonzero(free[size:] - free[:last] == size)
        return start, (self.run[start + size] - self.run[start]) * self.back[start]


def tile(item: np.ndarray, doc: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in doc, words), longest first, that overlap on neither side."""
    a, b = Windows(item), Windows(doc)
    open_a, open_b = np.ones(len(item), bool), np.ones(len(doc), bool)
    tiles: list[tuple[int, int, int]] = []
    most = min(len(item), len(doc))
    while most >= least:
        free_a, free_b = (np.concatenate([[0], np.cumsum(x)]) for x in (open_a, open_b))

        def matches(size: int, free_a=free_a, free_b=free_b):
            at_a, hash_a = a.of(size, free_a)
            at_b, hash_b = b.of(size, free_b)
            common = np.intersect1d(hash_a, hash_b)
            return at_a, hash_a, at_b, hash_b, common

        low, high = least - 1, most
        while low < high:
            middle = (low + high + 1) // 2
            if len(matches(middle)[4]):
                low = middle
            else:
                high = middle - 1
        if low < least:
            break
        at_a, hash_a, at_b, hash_b, common = matches(low)
        places: dict[int, list[int]] = {}
        for at, h in zip(at_b[np.isin(hash_b, common)].tolist(), hash_b[np.isin(hash_b, common)].tolist(), strict=True):
            places.setdefault(h, []).append(at)
        for spots in places.values():
            spots.reverse()
        shared = np.isin(hash_a, common)
        for at, h in zip(at_a[shared].tolist(), hash_a[shared].tolist(), strict=True):
            if not open_a[at:at + low].all():
                continue
            spots = places[h]
            while spots:
                there = spots.pop()
                if open_b[there:there + low].all():
                    open_a[at:at + low] = False
                    open_b[there:there + low] = False
                    tiles.append((at, there, low))
                    break
        most = low  # overlapping matches of this length may be left on one side only; shorter parts come next
        if not any(t[2] == low for t in tiles[-1:]):
            most = low - 1
    return tiles


@dataclass(frozen=True)
class Block:
    """Part of the benchmark: items' words, and their seeds in order of hash with the item each belongs to."""

    item_ids: list[int]
    words: list[np.ndarray]
    seeds: np.ndarray
    owners: np.ndarray


def load_block(items: pa.Table) -> Block:
    """The block of (item_id, text) rows."""
    data, offsets = utf8(pc.utf8_lower(items.column(1)))
    words = BareWords(data, offsets)
    row, seeds = words.shingles(MIN_TILE)
    pair = np.unique(np.stack([seeds, row.astype(np.uint64)]), axis=1)
    parts = [words.hash[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    return Block(items.column(0).to_pylist(), parts, pair[0], pair[1].astype(np.int64))


def candidates(row: np.ndarray, windows: np.ndarray, block: Block) -> np.ndarray:
    """Distinct (row, item) pairs that share a seed, as two rows."""
    if not len(block.seeds) or not len(windows):
        return np.zeros((2, 0), np.int64)
    low = np.searchsorted(block.seeds, windows, "left")
    found = block.seeds[np.minimum(low, len(block.seeds) - 1)] == windows
    key = np.unique(mixed(windows[found]) ^ (row[found].astype(np.uint64) * MIX), return_index=True)[1]
    low, row = low[found][key], row[found][key]
    size = np.searchsorted(block.seeds, windows[found][key], "right") - low
    before = np.cumsum(size) - size
    owner = block.owners[np.repeat(low - before, size) + np.arange(int(size.sum()))]
    return np.unique(np.stack([np.repeat(row, size), owner]), axis=1)


RESULT = "doc_id long, item_id long, item_words long, covered long, coverage double, longest_tile long, n_tiles long, first_word long, last_word long, mark long"


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, passage: int = PASSAGE) -> DataFrame:
    """One row per document and item that contaminates it, with the tiling's figures."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    total = items.agg(F.sum(n_words(F.col("text")))).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_WORDS))
    texts = doc_texts(docs).withColumn("mark", text_mark("text"))
    found = None
    for b in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b) if n_blocks > 1 else items
        passed = _pass(texts, load_block(part.toArrow()), coverage, passage)
        found = passed if found is None else found.unionByName(passed)
    return found


def _pass(texts: DataFrame, block: Block, coverage: float, passage: int) -> DataFrame:
    shipped = texts.sparkSession.sparkContext.broadcast(block)  # at most BLOCK_WORDS words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shipped.value
        for batch in in_pieces(batches, 1 << 19):
            words = BareWords(*utf8(pc.utf8_lower(batch.column(1))))
            names, marks = batch.column(0), batch.column(2)
            out = []
            for row, item in candidates(*words.shingles(MIN_TILE), block).T.tolist():
                doc, own = words.hash[words.first[row]:words.first[row + 1]], block.words[item]
                tiles = tile(own, doc)
                covered = sum(t[2] for t in tiles)
                longest = max(t[2] for t in tiles)
                if covered >= coverage * len(own) or longest >= passage:
                    out.append((names[row].as_py(), block.item_ids[item], len(own), covered, covered / len(own), longest, len(tiles),
                                min(t[1] for t in tiles), max(t[1] + t[2] for t in tiles) - 1, marks[row].as_py()))
            if out:
                kinds = [pa.int64()] * 4 + [pa.float64()] + [pa.int64()] * 5
                columns = [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])

    return texts.mapInArrow(run, RESULT)


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, passage: int = PASSAGE) -> DataFrame:
    """The rows of `docs` that no item contaminates, with all their columns."""
    return drop_marked(docs, leaks(docs, benchmark, coverage, passage))
