"""Exact repeats of 100 bytes and more by an enhanced suffix array that is dealt out by content.

1. Anchors. Every window of `WINDOW` bytes has one anchor, its `SEED`-byte string with the smallest hash (the leftmost of
   equals). Equal windows have equal anchors at the same place, so the windows of a repeat meet under their anchor's
   hash, wherever the repeats begin. Consecutive windows share an anchor and form a segment of at most 168 bytes.
2. Only anchors that occur twice can hold repeats: hashes are counted (one row per hash after the map-side sums) and joined back.
   Up to here the texts are read where they lie; a segment travels as two hashes and its place.
3. Equal segments are one row with their first occurrence. All windows of any other occurrence start earlier there.
4. Where an anchor has several different segments, their bytes are fetched and meet in one task, as parts of one suffix array with its longest common prefixes. A
   stack scan over it lists the intervals with a common prefix of a window or more; an interval is a maximal repeat if
   the bytes before its suffixes differ, or if one of them begins a segment (a longer repeat goes on in the segments
   before and after it). Of each maximal repeat all members but the first are repeated, and with them all windows
   that the common prefix covers.
5. An anchor with more than `HOT` different segments (a line that a third of all documents share, in different
   surroundings) would be too much for one task: its windows are compared by 128-bit digests in a map-side combined
   minimum instead. Where maximal repeats are listed, all strings between its repeated windows are counted by their digests, with the
   bytes before and after them: a string is a maximal repeat if both differ.

Texts are dealt out once, by doc_id, for fetching bytes and for cutting. Results: null or empty texts have 0 bytes; a
null doc_id comes before all others; rows that share a doc_id follow each other in the order of their texts; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphatlas.llm.common import MIX, in_pieces, mixed, span_hashes, utf8
from glyphatlas.session import cut_lineage, shuffle_width

WINDOW, SEED = 100, 32
REACH = WINDOW - SEED + 1
HOT = 20_000
CHUNK = 1 << 19
_PLACE = np.uint64((1 << 28) - 1)
_NO_ID = -(1 << 63)
_FACTOR = 0x9E3779B97F4A7C15


# --- anchors and segments ----------------------------------------------------------------------------------


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor place, anchor hash) of every segment, all rows one after the other."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none, none, np.zeros(0, np.uint64)
    h = data.astype(np.uint64) + np.uint64(1)
    size, factor = 1, _FACTOR
    while size < SEED:
        h = h[:len(h) - size] * np.uint64(factor) + h[size:]
        factor = factor * factor % (1 << 64)
        size *= 2
    h = mixed(h)
    key = h & ~_PLACE | np.arange(len(h), dtype=np.uint64) & _PLACE
    size = 1
    while size * 2 <= REACH:
        key = np.minimum(key[:len(key) - size], key[size:])
        size *= 2
    last = n - WINDOW + 1
    best = np.minimum(key[:last], key[REACH - size:REACH - size + last]) & _PLACE
    # places count modulo 2**28: the anchor of a window lies less than REACH ahead
    window = np.arange(last, dtype=np.uint64)
    place = (window + (best - window & _PLACE)).astype(np.int64)
    room = np.repeat(offsets[1:], np.diff(offsets))[:last]
    inside = np.arange(last) + WINDOW <= room
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (place[1:] != place[:-1])
    start = np.flatnonzero(begins)
    # windows without room part two documents, so a run ends at the next beginning or at the next of those
    stop = np.minimum(np.append(start[1:], last), np.concatenate([np.flatnonzero(~inside), [last]])[np.searchsorted(np.flatnonzero(~inside), start)])
    return start, stop - start, place[start], h[place[start]]


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, f, key, place) of all segments: hash of the anchor, hash of the segment's bytes with the anchor's place in it, and its
    copy, start and number of windows in one number whose order is that of (copy, start)."""
    for batch in in_pieces(batches, CHUNK):
        data, offsets = utf8(batch.column(2))
        start, windows, anchor, h = segments(data, offsets)
        row = np.searchsorted(offsets, start, "right") - 1
        f = mixed(span_hashes(data, start, start + windows - 1 + WINDOW) + (anchor - start).astype(np.uint64) * MIX)
        place = (np.array(batch.column(1), np.int64)[row] << 40) | ((start - offsets[row]) << 8) | windows
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(f.view(np.int64)), batch.column(0).take(pa.array(row)), pa.array(place)], ["h", "f", "key", "place"])


def _fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked segments of every text."""
    for batch in batches:
        keys, copies, out = batch.column(0), batch.column(1), []
        for i, (text, asked) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            raw = text.as_py().encode()
            for a in asked.as_py():
                start, windows = a["place"] >> 8 & 0xFFFFFFFF, a["place"] & 0xFF
                out.append((a["h"], a["f"], i, start, windows, raw[start:start + windows - 1 + WINDOW]))
        if out:
            h, f, row, start, windows, found = zip(*out, strict=True)
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h, pa.int64()), pa.array(f, pa.int64()), keys.take(row), copies.take(row), pa.array(start, pa.int32()), pa.array(windows, pa.int32()),
                 pa.array(found, pa.binary())], ["h", "f", "key", "copy", "start", "windows", "bytes"])


# --- suffix array ------------------------------------------------------------------------------------------


class SuffixArray:
    """The suffixes that begin a window of a set of segments, in the order of their bytes up to the end of the segment, with
    the longest common prefixes of neighbours (0 if shorter than a window)."""

    def __init__(self, data: np.ndarray, start: np.ndarray, windows: np.ndarray, group: np.ndarray):
        """Segments are spans of `data` that begin at `start`; only suffixes of the same group are compared."""
        n = len(data)
        end = start + windows - 1 + WINDOW
        inner = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        self.segment = np.repeat(np.arange(len(start)), windows)
        at = start[self.segment] + inner
        padded = np.concatenate([data, np.zeros(80, np.uint8)])
        word = np.zeros(n + 72, np.uint64)  # eight bytes from every place, the first one highest
        for i in range(8):
            word |= padded[i:n + 72 + i].astype(np.uint64) << np.uint64(56 - 8 * i)
        rank = self._ranks(word[:n])
        for size in (8, 16, 32):  # ranks of 16, 32 and 64 bytes by doubling
            ahead = np.zeros(n, np.int64)
            ahead[:n - size] = rank[size:]
            rank = self._ranks((rank.astype(np.uint64) << np.uint64(32)) | ahead.astype(np.uint64))
        # two overlapping 64-byte ranks tell the first WINDOW bytes
        head = self._ranks((rank[at].astype(np.uint64) << np.uint64(32)) | rank[at + WINDOW - 64].astype(np.uint64))
        joint = self._ranks((group[self.segment].astype(np.uint64) << np.uint64(32)) | head.astype(np.uint64))
        count = np.bincount(joint)
        twice = np.flatnonzero(count[joint] > 1)
        # behind the first WINDOW bytes, in order of what follows up to the end of the segment; an end comes first
        room = end[self.segment[twice]] - at[twice] - WINDOW
        tail = []
        for i in range(64, -8, -8):
            beyond = np.uint64(8) * (8 - np.clip(room - i, 0, 8)).astype(np.uint64)
            following = word[np.minimum(at[twice] + WINDOW + i, n)]
            tail.append(np.where(beyond == 64, np.uint64(0), following >> np.minimum(beyond, np.uint64(63)) << np.minimum(beyond, np.uint64(63))))
        order = twice[np.lexsort((room, *tail, joint[twice]))]
        self.at, self.segment, self.inner, self.left = at[order], self.segment[order], inner[order], end[self.segment[order]] - at[order]
        joint = joint[order]
        self.lcp = np.zeros(len(order) + 1, np.int64)
        same = np.flatnonzero(joint[1:] == joint[:-1]) + 1
        longest = np.minimum(self.left[same], self.left[same - 1])
        common = np.full(len(same), WINDOW)
        live = np.arange(len(same))
        a, b = self.at[same], self.at[same - 1]
        while len(live):
            differ = word[np.minimum(a[live] + common[live], n)] ^ word[np.minimum(b[live] + common[live], n)]
            common[live] += sum((differ < np.uint64(1 << bits)).astype(np.int64) for bits in range(0, 64, 8))
            live = live[(differ == 0) & (common[live] < longest[live])]
        self.lcp[same] = np.minimum(common, longest)
        # the byte before each suffix; a suffix that begins a segment counts as different from all
        self.before = np.where(self.inner == 0, -1 - np.arange(len(order)), data[np.maximum(self.at - 1, 0)].astype(np.int64))

    @staticmethod
    def _ranks(keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys)
        ranked = keys[order]
        new = np.ones(len(keys), np.int64)
        if len(keys):
            new[0] = 0
            new[1:] = ranked[1:] != ranked[:-1]
        out = np.empty(len(keys), np.int64)
        out[order] = np.cumsum(new)
        return out

    def maximal_repeats(self) -> Iterator[tuple[int, int, int]]:
        """(first, last, length): intervals of the array that are maximal repeats, by a stack scan over the prefixes.

        Each interval of the tree carries the byte before its suffixes, or None once two of them differ; an interval
        passes that on to its parent when it closes. Classes whose suffixes all stand behind the same byte are
        skipped whole: they are the shift of a repeat that begins one byte before.
        """
        edges = np.flatnonzero(self.lcp == 0)
        changes = np.concatenate([[0], np.cumsum(self.before[1:] != self.before[:-1])]) if len(self.before) else np.zeros(0, np.int64)
        first, last = edges[:-1], edges[1:] - 1
        open_classes = np.flatnonzero((last > first) & (changes[last] > changes[first])) if len(first) else ()
        lcp, before = self.lcp.tolist(), self.before.tolist()
        for c in open_classes:
            stack: list[list] = []  # length, first, byte before or None
            for i in range(first[c], last[c] + 1):
                length = lcp[i + 1] if i < last[c] else 0
                mark, begin = before[i], i
                while stack and stack[-1][0] > length:
                    node = stack.pop()
                    if node[2] != mark:
                        node[2] = None
                    if node[2] is None:
                        yield node[1], i, node[0]
                    mark, begin = node[2], node[1]
                if stack and stack[-1][0] == length:
                    if stack[-1][2] != mark:
                        stack[-1][2] = None
                elif length:
                    stack.append([length, begin, mark])


def _whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows ordered by h, in tables of about CHUNK bytes that part no group."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK:
            table = pa.Table.from_batches(held).combine_chunks()
            h = table.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1], "left"))
            if cut:
                yield table.slice(0, cut)
                held = table.slice(cut).combine_chunks().to_batches()
                size = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _scan(table: pa.Table):
    """The suffix array of a table of segments, the segments' first occurrences in order, and their places."""
    data, offsets = utf8(table.column("bytes"))
    number = lambda c: table.column(c).to_numpy()
    group = np.unique(number("h"), return_inverse=True)[1]
    windows, start = number("windows").astype(np.int64), number("start").astype(np.int64)
    array = SuffixArray(data, offsets[:-1], windows, group)
    order = np.lexsort((start[array.segment] + array.inner, number("copy")[array.segment], number("key")[array.segment]))
    turn = np.empty(len(order), np.int64)
    turn[order] = np.arange(len(order))
    return array, turn, start


def _repeated_first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, copy, start, end) of what starts earlier elsewhere, for the first occurrences of segments."""
    for table in _whole_groups(batches):
        array, turn, start = _scan(table)
        segment, low, high = [], [], []
        for first, last, length in array.maximal_repeats():
            spot = slice(first, last + 1)
            later = np.flatnonzero(turn[spot] != turn[spot].min()) + first
            begin = start[array.segment[later]] + array.inner[later]
            segment.append(array.segment[later])
            low.append(begin)
            high.append(begin + length)
        if segment:
            segment, low, high = np.concatenate(segment), np.concatenate(low), np.concatenate(high)
            # one row per run of a segment
            order = np.lexsort((low, segment))
            segment, low, high = segment[order], low[order], high[order]
            reach = np.maximum.accumulate(high + segment * (1 << 32)) - segment * (1 << 32)
            new = np.ones(len(segment), bool)
            new[1:] = (segment[1:] != segment[:-1]) | (low[1:] > reach[:-1])
            begin = np.flatnonzero(new)
            end = np.maximum.reduceat(high, begin)
            picked = pa.array(segment[begin])
            yield pa.RecordBatch.from_arrays(
                [table.column("key").combine_chunks().take(picked), table.column("copy").combine_chunks().take(picked),
                 pa.array(low[begin].astype(np.int32)), pa.array(end.astype(np.int32))], ["key", "copy", "start", "end"])


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(repeat, length, h, f, inner): members of maximal repeats, as places in segments."""
    for table in _whole_groups(batches):
        array, _, _ = _scan(table)
        h, f = (table.column(c).combine_chunks() for c in ("h", "f"))
        for first, last, length in array.maximal_repeats():
            n = last + 1 - first
            inside = pa.array(array.segment[first:last + 1])
            name = f"{h[int(array.segment[first])]}:{f[int(array.segment[first])]}:{array.inner[first]}:{length}"
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n), pa.array([length] * n, pa.int32()), h.take(inside), f.take(inside), pa.array(array.inner[first:last + 1].astype(np.int32))],
                ["repeat", "length", "h", "f", "inner"])


def _every_window(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w1, w2, key, copy, start): digests of all windows of hot segments."""
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        data, offsets = utf8(table.column("bytes"))
        windows = table.column("windows").to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(batch.num_rows), windows)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = offsets[owner] + inner
        picked = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [pa.array(span_hashes(data, at, at + WINDOW).view(np.int64)), pa.array(span_hashes(data ^ np.uint8(0x5A), at, at + WINDOW).view(np.int64)),
             table.column("key").combine_chunks().take(picked), table.column("copy").combine_chunks().take(picked),
             pa.array((table.column("start").to_numpy()[owner] + inner).astype(np.int32))], ["w1", "w2", "key", "copy", "start"])


def _every_part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(s1, s2, length, h, f, inner, before, after): digests of all strings between repeated windows of hot segments, with the bytes on
    either side, or -1 where the segment begins or ends. Without a column `repeated`, of all single windows."""
    for batch in in_slices(batches, 64):
        data, offsets = utf8(batch.column(2))
        single = batch.num_columns == 4
        owner, first, last = [], [], []
        for i in range(batch.num_rows):
            if single:
                a = b = np.arange(batch.column(3)[i].as_py())
            else:
                inner = np.sort(np.array(batch.column(4)[i].as_py(), np.int64))
                a, b = np.triu_indices(len(inner))
                whole = inner[b] - inner[a] == b - a  # no gap between them
                a, b = inner[a[whole]], inner[b[whole]]
            owner.append(np.full(len(a), i))
            first.append(a)
            last.append(b)
        owner, first, last = np.concatenate(owner), np.concatenate(first), np.concatenate(last)
        start, end = offsets[owner] + first, offsets[owner] + last + WINDOW
        before = np.where(first == 0, -1, data[np.maximum(start - 1, 0)].astype(np.int64))
        after = np.where(end == offsets[owner + 1], -1, data[np.minimum(end, len(data) - 1)].astype(np.int64))
        picked = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [pa.array(span_hashes(data, start, end).view(np.int64)), pa.array(span_hashes(data ^ np.uint8(0x5A), start, end).view(np.int64)),
             pa.array((end - start).astype(np.int32)), batch.column(0).take(picked), batch.column(1).take(picked), pa.array(first.astype(np.int32)),
             pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32))], ["s1", "s2", "length", "h", "f", "inner", "before", "after"])


def in_slices(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `most` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most)


# --- jobs ------------------------------------------------------------------------------------------------


def _numbered(docs: DataFrame) -> DataFrame:
    """(key, copy, text): doc_id without nulls, and a number that tells rows apart that share one."""
    laid = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("key"), F.isnull("doc_id").cast("int").alias("copy"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    shared = cut_lineage(laid.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    if shared.isEmpty():
        return laid
    some = laid.join(shared, "key", "left_semi").select("key", F.row_number().over(W.partitionBy("key").orderBy("text")).alias("copy"), "text")
    return laid.join(shared, "key", "left_anti").select("key", "copy", "text").unionByName(some)


def _dealt(texts: DataFrame) -> DataFrame:
    """The texts by (key, copy): the exchange that all later joins share."""
    return texts.repartition(shuffle_width(texts.sparkSession), "key", "copy")


def _occurrences(texts: DataFrame) -> DataFrame:
    """(h, f, key, place) of the segments whose anchor occurs twice or more."""
    sketched = texts.mapInArrow(_sketch, "h long, f long, key long, place long")
    repeated = sketched.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    return cut_lineage(sketched.join(repeated, "h"))


def _first_ones(occurrences: DataFrame) -> DataFrame:
    """(h, f, n, first) of the distinct segments: number of occurrences, and key and place of the first."""
    return cut_lineage(occurrences.groupBy("h", "f").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("first")))


def _fetched(dealt: DataFrame, firsts: DataFrame, hot: bool) -> DataFrame:
    """First occurrences, with their bytes, of the segments whose anchor has others as well; of hot anchors or of the rest."""
    kinds = firsts.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"))
    chosen = kinds.where(F.col("kinds") > HOT if hot else (F.col("kinds") > 1) & (F.col("kinds") <= HOT))
    wanted = firsts.join(chosen.select("h"), "h").select("h", "f", "first.key", "first.place")
    asked = wanted.groupBy("key", F.shiftright("place", 40).cast("int").alias("copy")).agg(F.collect_list(F.struct("h", "f", "place")).alias("asked"))
    rows = dealt.join(cut_lineage(asked), ["key", "copy"]).select("key", "copy", "text", "asked")
    return rows.mapInArrow(_fetch, "h long, f long, key long, copy int, start int, windows int, bytes binary")


def _by_anchor(fetched: DataFrame) -> DataFrame:
    return fetched.repartition(shuffle_width(fetched.sparkSession), "h").sortWithinPartitions("h")


def removed_runs(dealt: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, copy, start, end): runs of bytes that strings starting earlier cover; they may overlap."""
    occurrences = _occurrences(texts)
    firsts = _first_ones(occurrences)
    spans = "key long, copy int, start int, end int"
    runs = _by_anchor(_fetched(dealt, firsts, False)).mapInArrow(_repeated_first, spans)
    hot = firsts.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > HOT)
    if not hot.isEmpty():
        windows = _fetched(dealt, firsts, True).mapInArrow(_every_window, "w1 long, w2 long, key long, copy int, start int")
        earliest = windows.groupBy("w1", "w2").agg(F.min(F.struct("key", "copy", "start")).alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1")
        later = windows.join(earliest, ["w1", "w2"]).where(F.struct("key", "copy", "start") != F.col("earliest"))
        runs = runs.unionByName(later.select("key", "copy", "start", (F.col("start") + WINDOW).alias("end")))
    begins = firsts.where("n > 1").select("h", "f", "first")
    others = occurrences.join(begins, ["h", "f"]).where(F.struct("key", "place") != F.col("first"))
    start = F.shiftright("place", 8).bitwiseAND(F.lit(0xFFFFFFFF))
    return runs.unionByName(others.select(
        "key", F.shiftright("place", 40).cast("int").alias("copy"), start.cast("int").alias("start"),
        (start + F.col("place").bitwiseAND(F.lit(0xFF)) + (WINDOW - 1)).cast("int").alias("end")))


def _hot_groups(segments_of: DataFrame) -> DataFrame:
    """(repeat, length, h, f, inner) like `_groups`, for hot anchors: by digests, so that no task holds an anchor."""
    parts = "s1 long, s2 long, length int, h long, f long, inner int, before int, after int"
    held = cut_lineage(segments_of.select("h", "f", "bytes", "windows"))
    windows = held.mapInArrow(_every_part, parts)
    twice = windows.groupBy("s1", "s2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("s1", "s2")
    repeated = windows.join(twice, ["s1", "s2"]).groupBy("h", "f").agg(F.collect_list("inner").alias("repeated"))
    open_ones = cut_lineage(held.join(repeated, ["h", "f"]).select("h", "f", "bytes", "windows", "repeated"))
    strings = open_ones.mapInArrow(_every_part, parts)
    differ = lambda c: (F.min(c) == -1) | (F.min(c) != F.max(c))
    maximal = strings.groupBy("s1", "s2", "length").agg(F.count(F.lit(1)).alias("n"), (differ("before") & differ("after")).alias("both"))
    return strings.join(maximal.where("n > 1 AND both").select("s1", "s2", "length"), ["s1", "s2", "length"]).select(
        F.concat_ws(":", F.lit("hot"), "s1", "s2", "length").alias("repeat"), "length", "h", "f", "inner")


def maximal_repeats(docs: DataFrame) -> DataFrame:
    """(repeat, length, doc_id, start): all occurrences of every maximal repeat within segments that differ elsewhere; a repeat of more
    than a segment is a chain of overlapping ones, and segments that are equal throughout are the occurrences of one."""
    texts = _numbered(docs)
    dealt = _dealt(texts)
    occurrences = _occurrences(texts)
    firsts = _first_ones(occurrences)
    found = _by_anchor(_fetched(dealt, firsts, False)).mapInArrow(_groups, "repeat string, length int, h long, f long, inner int")
    hot = firsts.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > HOT)
    if not hot.isEmpty():
        found = found.unionByName(_hot_groups(_fetched(dealt, firsts, True)))
    whole = firsts.where("n > 1").select(
        F.concat_ws(":", "h", "f", F.lit("all")).alias("repeat"), (F.col("first.place").bitwiseAND(F.lit(0xFF)) + (WINDOW - 1)).cast("int").alias("length"), "h", "f",
        F.lit(0).alias("inner"))
    start = F.shiftright("place", 8).bitwiseAND(F.lit(0xFFFFFFFF)) + F.col("inner")
    return found.unionByName(whole).join(occurrences, ["h", "f"]).select(
        "repeat", "length", F.when(F.col("key") != _NO_ID, F.col("key")).alias("doc_id"), start.cast("int").alias("start"))


def _kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_text")}
        for text, runs in zip(batch.column(1), batch.column(2), strict=True):
            raw = text.as_py().encode()
            spans = np.array(sorted((r["start"], r["end"]) for r in runs.as_py() or ()), np.int64).reshape(-1, 2)
            removed, n_spans, pieces, at = 0, 0, [], 0
            if len(spans):
                reach = np.maximum.accumulate(spans[:, 1])
                new = np.append(True, spans[1:, 0] > reach[:-1])
                begin = np.flatnonzero(new)
                ends = reach[np.append(begin[1:], len(spans)) - 1]
                for a, b in zip(spans[begin, 0].tolist(), ends.tolist(), strict=True):
                    pieces.append(raw[at:a])
                    removed, n_spans, at = removed + b - a, n_spans + 1, b
            pieces.append(raw[at:])
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(removed)
            out["n_spans"].append(n_spans)
            out["kept_text"].append(b"".join(pieces))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")],
             pa.array([hashlib.sha256(x).hexdigest() for x in out["kept_text"]]), pa.array(out["kept_text"], pa.binary())],
            ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes) for every row of `docs`."""
    texts = _numbered(docs)
    dealt = _dealt(texts)
    runs = removed_runs(dealt, texts).groupBy("key", "copy").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    joined = dealt.join(runs, ["key", "copy"], "left").select("key", "text", "runs")
    kept = joined.mapInArrow(_kept, "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary")
    return kept.select(F.when(F.col("key") != _NO_ID, F.col("key")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes")
