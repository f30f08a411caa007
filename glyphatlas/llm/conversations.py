"""Repair of conversation structure: the cheapest edits that make the roles follow `(s?(ua)+)?`, and of these the least audit.

Rows lie in order of (conversation, turn) over ranges of that whole order, so a conversation of any length is spread over
as many ranges as it needs; the rows of a conversation within a range are a portion.

1. Cost DP. Nodes are (place between rows, what the last role was): nothing, system, user or assistant. Keep, Rerole and Delete lead past a
   row, Insert stays in front of it. A portion of a conversation that goes on elsewhere is summed up by the cheapest way from each of the
   four states to each: 16 numbers. There are at most two such portions a range, and the driver chains them.
2. Path ranking by prefix doubling. With the cost of every node, the arcs that a cheapest repair can take are known. The nodes are ranked by the first
   letter of their audits, then by the first two, four, eight letters: the pair of a node's rank and the rank of the node that its doubled pointer
   reaches is the rank of twice the length. The arcs of a node carry different letters, so the least audit of each length
   leads to a single node. When all pointers have reached an end, they give the nodes of the least path at all places at once.

Defined results: null turns come first; rows of the same turn go by role and by the SHA-256 of the text; a role without a first letter, or with another
one than s, u and a, is never kept; identical rows are duplicates of the first; a null conversation is a conversation of its own.
Further columns stay behind. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphatlas.llm.common import join_with_hot_keys, null_safe_join
from glyphatlas.llm.token_codes import scratch
from glyphatlas.session import cut_lineage, shuffle_width

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
INITIALS = "sua"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# what a further user or assistant turn leads to, and which of the two it is
FORWARD = np.array([USER, USER, ASSISTANT, USER])
TURN_ROLE = np.array(["user", "user", "assistant", "user"], object)
# where a kept row leads, by its initial (s, u, a, other) and the state before; -1: nowhere
KEPT = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1, -1, -1, -1]])
LETTERS = np.frombuffer(b" DIKR", np.uint8)  # in order of their codes
FAR = np.int64(1) << 50
DONE = np.array([0, FAR, FAR, 0])
TOGETHER = 1 << 14
PIECE = 1 << 20
WHITE = " \t\n\x0b\x0c\r"


# --- rows with their faults, in order ------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage by crc32(`conv_id:turn`) % 20; nulls count as one space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    role = F.when(kind == 4, "user").otherwise(said("role"))
    rows = conversations.where(kind != 0).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("again"))
    return rows.drop("again")


def laid_out(rows: DataFrame) -> DataFrame:
    """The rows with their faults, in ranges of (conversation, turn): part, lost (a null conversation), conv, turn, role, text, blank, duplicate, truncated."""
    stripped = F.rtrim(F.col("text"), F.lit(WHITE))
    named = rows.select(
        F.col("conv_id").isNull().alias("lost"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    # identical rows are one from here on, with their number
    folded = named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("times"))
    keys = ["lost", "conv", "role", "digest"]
    judged = lambda df: df.withColumns({
        "digest": F.sha2(F.col("text").cast("binary"), 256), "blank": stripped == "", "dated": F.col("turn").isNotNull()})
    spoken = judged(folded).where(~F.col("blank"))
    seen = judged(named).where(~F.col("blank")).groupBy(*keys).agg(
        F.min(F.struct("dated", "turn")).alias("first"), F.count(F.lit(1)).alias("said"))
    known = join_with_hot_keys(spoken, cut_lineage(seen), keys, "said").withColumn("late", F.struct("dated", "turn") > F.col("first"))
    columns = [*named.columns, "digest", "blank", "dated", "times", "late"]
    marked = known.select(*columns).unionByName(judged(folded).where("blank").withColumn("late", F.lit(False)).select(*columns))
    each = marked.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times"))))
    duplicate = ~F.col("blank") & (F.col("late") | (F.col("nth") > 1))
    truncated = ~F.col("blank") & ~duplicate & ~F.right(stripped, F.lit(1)).isin(".", "!", "?")
    order: list[Column] = [F.col(c) for c in ("lost", "conv", "dated", "turn", "role", "digest", "nth")]
    ranged = each.withColumns({"duplicate": duplicate, "truncated": truncated}).repartitionByRange(shuffle_width(rows.sparkSession), *order)
    return cut_lineage(ranged.sortWithinPartitions(*order).select(
        F.spark_partition_id().alias("part"), "lost", "conv", "turn", "role", "text", "blank", "duplicate", "truncated"))


class Portions:
    """The portions that lie in `rows`, one after the other: `start` and `n` rows of each, and their rows as arrays."""

    def __init__(self, rows: pa.Table, start: np.ndarray, first: bool, last: bool):
        self.rows, self.start = rows, start
        self.n = np.diff(start, append=rows.num_rows)
        self.part = rows.column("part")[0].as_py()
        self.key = [(rows.column("lost")[i].as_py(), rows.column("conv")[i].as_py()) for i in start.tolist()]
        # portions that another range may go on with
        self.edge = np.zeros(len(start), bool)
        self.edge[0] |= first
        self.edge[-1] |= last
        column = lambda c: rows.column(c).to_numpy()
        self.blank, self.duplicate, self.truncated = column("blank"), column("duplicate"), column("truncated")
        self.must_go = self.blank | self.duplicate
        initial = pc.index_in(pc.utf8_slice_codeunits(rows.column("role"), 0, 1), pa.array(list(INITIALS)))
        self.initial = pc.fill_null(initial, len(INITIALS)).to_numpy().astype(np.int64)

    def summed(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x.astype(np.int64), self.start)


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[Portions]:
    """The portions of a range, many short ones or a single long one at a time."""
    held: list[pa.RecordBatch] = []
    n, first = 0, True

    def starts(table: pa.Table) -> np.ndarray:
        lost, conv = table.column("lost").to_numpy(), table.column("conv").to_numpy()
        return np.flatnonzero(np.concatenate([[True], (lost[1:] != lost[:-1]) | (conv[1:] != conv[:-1])]))

    def apart(table: pa.Table, begin: np.ndarray, last: bool) -> Iterator[Portions]:
        alone = len(begin) > 1 and int(begin[1]) > TOGETHER  # a long portion stands alone
        if alone:
            yield Portions(table.slice(0, int(begin[1])), begin[:1], first, False)
            table, begin = table.slice(int(begin[1])), begin[1:] - begin[1]
        yield Portions(table, begin, first and not alone, last)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < TOGETHER:
            continue
        table = pa.Table.from_batches(held)
        begin = starts(table)
        if len(begin) > 1:
            yield from apart(table.slice(0, int(begin[-1])), begin[:-1], False)
            first = False
            table = table.slice(int(begin[-1]))
        # a portion that is still open is looked at again when as many rows have come
        held, n = table.to_batches(), 0
    if held:
        table = pa.Table.from_batches(held)
        yield from apart(table, starts(table), True)


# --- cost DP ------------------------------------------------------------------------------------------------


def with_inserts(best: np.ndarray) -> np.ndarray:
    """The costs of the four states at a place, when turns may be inserted there."""
    user = np.minimum(best[..., USER], best[..., ASSISTANT] + INSERT)
    out = np.stack([np.minimum(best[..., NOTHING], user + INSERT), np.minimum(best[..., SYSTEM], user + INSERT), user,
                    np.minimum(best[..., ASSISTANT], best[..., USER] + INSERT)], axis=-1)
    return np.minimum(out, FAR)


def costs(p: Portions, which: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The cost from every node of the portions `which` to the end, given what the states cost behind the last row: (places, 4), portion
    after portion, each with one place more than it has rows."""
    n, start = p.n[which], p.start[which]
    base = np.cumsum(n + 1) - n - 1
    out = np.empty((int((n + 1).sum()), 4), np.int64)
    out[base + n] = end
    turn = np.argsort(-n, kind="stable")
    for back in range(1, int(n.max()) + 1):
        turn = turn[n[turn] >= back]
        row, place = (start + n)[turn] - back, (base + n)[turn] - back
        behind = out[place + 1]
        stays = np.where(p.must_go[row], FAR, p.truncated[row] * TRUNCATED)[:, None]
        kept = KEPT[p.initial[row]]
        keep = np.where(kept >= 0, np.take_along_axis(behind, np.maximum(kept, 0), 1) + KEEP, FAR) + stays
        best = np.minimum(np.minimum(behind + DELETE, keep), behind[:, FORWARD] + REROLE + stays)
        out[place] = with_inserts(best)
    return out


# --- path ranking ---------------------------------------------------------------------------------------------


def cheapest_arcs(p: Portions, portion: int | None, cost: np.ndarray, low: int, high: int, final: bool) -> tuple[np.ndarray, np.ndarray]:
    """(letter, target) of every node between two places: the least letter among the arcs that a cheapest repair can take, and the node that it leads to.

    With `portion`, the places `low` to `high` of this portion; without, all places of all portions. Nodes without such arcs are ends: letter 0.
    """
    if portion is None:
        places = len(cost)
        row = np.arange(places) - np.repeat(np.arange(len(p.n)), p.n + 1)
        inner = np.ones(places, bool)
        inner[np.cumsum(p.n + 1) - 1] = False
        closes = np.full(places, final)
    else:
        places = high - low + 1
        cost = cost[low:high + 1]
        row = p.start[portion] + np.arange(low, high + 1)
        inner = np.arange(places) < places - 1
        closes = np.full(places, final and high == p.n[portion])
    row = np.minimum(row, p.rows.num_rows - 1)
    behind = np.concatenate([cost[1:], np.full((1, 4), FAR)])
    stays = np.where(p.must_go[row], FAR, p.truncated[row] * TRUNCATED)[:, None]
    kept = KEPT[p.initial[row]]
    live = cost < FAR
    here = np.arange(places)[:, None] * 4
    passes = live & inner[:, None]
    keep_to = np.maximum(kept, 0)
    arcs = [  # by letter: D, I, K, R
        (passes & (cost == behind + DELETE), here + 4 + np.arange(4)),
        (live & (inner | closes)[:, None] & (cost == cost[:, FORWARD] + INSERT), here + FORWARD),
        (passes & (kept >= 0) & (cost == np.take_along_axis(behind, keep_to, 1) + KEEP + stays), here + 4 + keep_to),
        (passes & (cost == behind[:, FORWARD] + REROLE + stays), here + 4 + FORWARD),
    ]
    letter, target = np.zeros((places, 4), np.int64), here + np.arange(4)
    for code in range(len(arcs), 0, -1):
        open_, to = arcs[code - 1]
        letter, target = np.where(open_, code, letter), np.where(open_, to, target)
    return letter.ravel(), target.ravel()


def least_paths(letter: np.ndarray, target: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, steps, ends, rank): the nodes of the least path from each entry, one path after the other, the number of its steps, the node where it
    ends, and the rank of every node's whole audit (an audit comes behind its own prefixes)."""
    rank, jump, steps = letter, target, (letter > 0).astype(np.int64)
    doubled = [jump]
    while (letter[jump] > 0).any():
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[jump], return_inverse=True)[1]
        steps = steps + steps[jump]
        jump = jump[jump]
        doubled.append(jump)
    many = steps[entry]
    node = np.repeat(entry, many)
    at = np.arange(len(node)) - np.repeat(np.cumsum(many) - many, many)
    for k, jumps in enumerate(doubled):
        node = np.where(at >> k & 1, jumps[node], node)
    return node, many, doubled[-1][entry], rank


def paths(p: Portions, end: np.ndarray, entry: np.ndarray, final: bool) -> tuple[np.ndarray, ...]:
    """(letters, row, state, edits of each portion, exit state, cost): the cheapest edits of the portions with the least audits."""
    cost = costs(p, np.arange(len(p.n)), end)
    if len(p.n) > 1 or p.n[0] <= TOGETHER:
        base = np.cumsum(p.n + 1) - p.n - 1
        letter, target = cheapest_arcs(p, None, cost, 0, 0, final)
        node, many, ends, _ = least_paths(letter, target, base * 4 + entry)
        row = node // 4 - np.repeat(np.arange(len(p.n)), many)
        return letter[node], row, node % 4, many, ends % 4, cost[base, entry]
    found, state = [], int(entry[0])
    for low in range(0, int(p.n[0]), TOGETHER):  # a long portion, stretch after stretch
        high = min(low + TOGETHER, int(p.n[0]))
        letter, target = cheapest_arcs(p, 0, cost, low, high, final)
        node, many, ends, _ = least_paths(letter, target, np.array([state]))
        found.append((letter[node], node // 4 + low, node % 4))
        state = int(ends[0]) % 4
    letters, row, states = (np.concatenate(x) for x in zip(*found, strict=True))
    return letters, row, states, np.array([len(letters)]), np.array([state]), cost[0, entry]


# --- conversations that several ranges hold -----------------------------------------------------------------------

Way = dict[tuple[int, bool, int], tuple[list[int], int, bool]]


def _edge_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for p in portions(batches):
        for i in np.flatnonzero(p.edge).tolist():
            ways = [costs(p, np.array([i]), np.where(np.arange(4) == t, 0, FAR)[None, :])[0].tolist() for t in range(4)]
            lost, conv = p.key[i]
            yield pa.RecordBatch.from_pylist([{"part": p.part, "lost": lost, "conv": conv, "ways": sum(ways, [])}], pa.schema(
                [("part", pa.int32()), ("lost", pa.bool_()), ("conv", pa.int64()), ("ways", pa.list_(pa.int64()))]))


def _edge_exits(known: Way) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in portions(batches):
            for i in np.flatnonzero(p.edge).tolist():
                if (found := known.get((p.part, *p.key[i]))) is None:
                    continue
                end, _, final = found
                alone = _only(p, i)
                exits = [int(paths(alone, np.array([end]), np.array([s]), final)[4][0]) for s in range(4)]
                yield pa.RecordBatch.from_pylist([{"part": p.part, "lost": p.key[i][0], "conv": p.key[i][1], "exits": exits}], pa.schema(
                    [("part", pa.int32()), ("lost", pa.bool_()), ("conv", pa.int64()), ("exits", pa.list_(pa.int64()))]))

    return run


def _only(p: Portions, i: int) -> Portions:
    return Portions(p.rows.slice(int(p.start[i]), int(p.n[i])), np.zeros(1, np.int64), False, False)


def crossings(laid: DataFrame) -> Way:
    """By (part, lost, conv), for portions of conversations that several ranges hold: what the states cost behind the portion, the state in front of it, and
    whether it is the last. A range has at most two such portions."""
    edges = sorted((tuple(r) for r in laid.mapInArrow(_edge_costs, "part int, lost boolean, conv long, ways array<long>").collect()), key=lambda r: (r[1], r[2], r[0]))
    chains: dict[tuple[bool, int], list] = {}
    for part, lost, conv, ways in edges:
        chains.setdefault((lost, conv), []).append((part, np.array(ways).reshape(4, 4)))
    chains = {k: v for k, v in chains.items() if len(v) > 1}
    known: Way = {}
    for (lost, conv), chain in chains.items():
        behind = with_inserts(DONE)
        for i, (part, ways) in reversed(list(enumerate(chain))):
            known[part, lost, conv] = behind.tolist(), NOTHING, i == len(chain) - 1
            behind = np.minimum((ways + behind[:, None]).min(axis=0), FAR)
    if known:
        exits = {tuple(r)[:3]: r["exits"] for r in laid.mapInArrow(_edge_exits(known), "part int, lost boolean, conv long, exits array<long>").collect()}
        for (lost, conv), chain in chains.items():
            state = NOTHING
            for part, _ in chain:
                end, _, final = known[part, lost, conv]
                known[part, lost, conv] = end, state, final
                state = exits[part, lost, conv][state]
    return known


def _solved(p: Portions, known: Way) -> Iterator[tuple[Portions, bool, tuple[np.ndarray, ...]]]:
    """(portions, whether they are parts of a conversation, their paths): the whole conversations together, the parts each on its own."""
    cut = [i for i in np.flatnonzero(p.edge).tolist() if (p.part, *p.key[i]) in known]
    left = 0
    for i in [*cut, len(p.n)]:
        if left < i:
            begin = int(p.start[left])
            to = int(p.start[i]) if i < len(p.n) else p.rows.num_rows
            some = Portions(p.rows.slice(begin, to - begin), p.start[left:i] - begin, False, False)
            yield some, False, paths(some, with_inserts(DONE), np.zeros(i - left, np.int64), True)
        if i < len(p.n):
            end, state, final = known[p.part, *p.key[i]]
            alone = _only(p, i)
            yield alone, True, paths(alone, np.array([end]), np.array([state]), final)
        left = i + 1


# --- results --------------------------------------------------------------------------------------------------


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, part, nth, edit, turn, role, text): every edit of the repair of the (conv_id, turn, role, text) conversations, in order of (part, nth), with the turn that it
    leaves, or for D the row that goes."""
    laid = laid_out(rows)
    known = crossings(laid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = 0
        for p in portions(batches):
            for some, _, (letters, row, state, many, _, _) in _solved(p, known):
                safe = pa.array(np.minimum(row, some.rows.num_rows - 1))
                table = some.rows.take(safe)
                inserted, named = letters == 2, (letters == 2) | (letters == 4)
                role = np.where(named, TURN_ROLE[state], table.column("role").to_numpy())
                owner = np.repeat(np.arange(len(many)), many)
                conv = [None if some.key[i][0] else some.key[i][1] for i in owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(conv, pa.int64()), pa.array(np.full(len(row), some.part), pa.int32()), pa.array(np.arange(len(row)) + nth),
                     pa.array([chr(c) for c in LETTERS[letters]], pa.string()),
                     pc.if_else(pa.array(inserted), pa.scalar(None, pa.int64()), table.column("turn").combine_chunks()),
                     pa.array(role, pa.string()), pc.if_else(pa.array(inserted), "", table.column("text").combine_chunks())],
                    ["conv_id", "part", "nth", "edit", "turn", "role", "text"])
                nth += len(row)

    return laid.mapInArrow(run, "conv_id long, part int, nth long, edit string, turn long, role string, text string")


DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
COUNTS = ("turns", "blank", "duplicate", "truncated", "illegal", "cost")
_PART_SCHEMA = (
    "lost boolean, conv long, part int, cut boolean, piece int, low long, high long, first int, last int, "
    + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, held binary, repaired_sha256 string")


def _legal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    pair = before * 4 + after
    return (pair == 1) | (pair == 6) | (pair == 9)  # su, ua, au


def _parts(known: Way) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in portions(batches):
            for some, cut, (letters, row, state, many, _, cost) in _solved(p, known):
                yield from _described(some, cut, letters, row, state, many, cost)

    return run


def _described(p: Portions, cut: bool, letters: np.ndarray, row: np.ndarray, state: np.ndarray, many: np.ndarray, cost: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for every portion; the repaired text of parts of a conversation follows in pieces."""
    r = p.rows.num_rows
    turn = p.rows.column("turn")
    dated = turn.is_valid().to_numpy()
    value = pc.fill_null(turn, 0).to_numpy()
    begins = np.zeros(r, bool)
    begins[p.start] = True
    new = dated.copy()
    new[1:] &= begins[1:] | ~dated[:-1] | (value[1:] != value[:-1])
    top = np.iinfo(np.int64).max
    low, high = np.minimum.reduceat(np.where(dated, value, top), p.start), np.maximum.reduceat(np.where(dated, value, -top), p.start)
    illegal = np.zeros(r, bool)
    illegal[1:] = ~begins[1:] & ~_legal(p.initial[:-1], p.initial[1:])
    counts = [p.summed(new), p.summed(p.blank), p.summed(p.duplicate), p.summed(p.truncated), p.summed(illegal), cost]
    audit = LETTERS[letters].tobytes().decode()
    roles, texts = p.rows.column("role").to_pylist(), p.rows.column("text").to_pylist()
    stays = np.flatnonzero(letters != 1)
    said = []
    for code, i, s in zip(letters[stays].tolist(), row[stays].tolist(), state[stays].tolist(), strict=True):
        said.append((roles[i] if code == 3 else TURN_ROLE[s]) + ":" + ("" if code == 2 else texts[i]))
    ends = np.cumsum(many)
    said_to = np.searchsorted(stays, ends).tolist()
    rows = []
    for i, ((lost, conv), a, b) in enumerate(zip(p.key, [0, *said_to[:-1]], said_to, strict=True)):
        begin, stop = int(p.start[i]), int(p.start[i] + p.n[i])
        one = {"lost": lost, "conv": conv, "part": p.part, "cut": cut, "piece": 0, "low": int(low[i]), "high": int(high[i]),
               "first": int(p.initial[begin]), "last": int(p.initial[stop - 1]), **{c: int(x[i]) for c, x in zip(COUNTS, counts, strict=True)},
               "audit": audit[int(ends[i] - many[i]):int(ends[i])], "held": None, "repaired_sha256": None}
        if not cut:
            one["repaired_sha256"] = hashlib.sha256("\n".join(said[a:b]).encode()).hexdigest()
        rows.append(one)
    if cut:
        whole = "".join(s + "\n" for s in said).encode()
        rows += [rows[0] | {"piece": k, "audit": None, "held": whole[at:at + PIECE]} for k, at in enumerate(range(0, len(whole), PIECE), 1)]
    schema = pa.schema([
        ("lost", pa.bool_()), ("conv", pa.int64()), ("part", pa.int32()), ("cut", pa.bool_()), ("piece", pa.int32()), ("low", pa.int64()), ("high", pa.int64()),
        ("first", pa.int32()), ("last", pa.int32()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("held", pa.binary()), ("repaired_sha256", pa.string())])
    yield pa.RecordBatch.from_pylist(rows, schema)


def _gaps(low: int, high: int, turns: int) -> int:
    return high - low + 1 - turns if turns else 0


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose portions come one after the other; text runs through the hash piece by piece."""
    now, total, audit, hashed, waiting = None, {}, [], None, b""

    def closed() -> pa.RecordBatch:
        hashed.update(waiting[:-1])  # no line break behind the last turn
        return _digest_rows([{**total, "audit": "".join(audit), "repaired_sha256": hashed.hexdigest()}])

    for batch in batches:
        for r in batch.to_pylist():
            if now != (r["lost"], r["conv"]):
                if now is not None:
                    yield closed()
                now, total, audit, hashed, waiting = (r["lost"], r["conv"]), dict(r), [r["audit"]], hashlib.sha256(), b""
            elif r["piece"] == 0:
                same = r["turns"] > 0 and total["turns"] > 0 and r["low"] == total["high"]
                total["turns"] += r["turns"] - same
                total["illegal"] += r["illegal"] + int(not _legal(np.array(total["last"]), np.array(r["first"])))
                for c in ("blank", "duplicate", "truncated"):
                    total[c] += r[c]
                total["low"], total["high"], total["last"] = min(total["low"], r["low"]), max(total["high"], r["high"]), r["last"]
                audit.append(r["audit"])
            if r["held"]:
                hashed.update(waiting)
                waiting = r["held"]
    if now is not None:
        yield closed()


def _digest_rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                       ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return pa.RecordBatch.from_pylist([
        {**{k.name: r.get(k.name) for k in kinds}, "conv_id": None if r["lost"] else r["conv"], "gaps": _gaps(r["low"], r["high"], r["turns"])} for r in rows], kinds)


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of (conv_id, turn, role, text) rows.

    The digest of a repaired text is a chain from its first to its last byte: text of a conversation that several ranges hold
    streams through one task, piece by piece; all other work on it is spread.
    """
    laid = laid_out(rows)
    place = scratch(rows.sparkSession, "repaired")
    laid.mapInArrow(_parts(crossings(laid)), _PART_SCHEMA).write.parquet(place)
    parts = rows.sparkSession.read.parquet(place)
    gaps = F.when(F.col("turns") > 0, F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(F.lit(0))
    whole = parts.where("NOT cut").select(
        F.when(~F.col("lost"), F.col("conv")).alias("conv_id"), gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    spread = parts.where("cut").repartition(shuffle_width(rows.sparkSession), "lost", "conv").sortWithinPartitions("lost", "conv", "part", "piece")
    return whole.unionByName(spread.mapInArrow(_joined, DIGEST))


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """The digests of every conversation after damage; one without rows after damage has zeros and an empty audit and text."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = null_safe_join(ids, digests(damaged(conversations)), ["conv_id"], "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    nothing = hashlib.sha256(b"").hexdigest()
    return found.withColumns({**zero, "audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(nothing))})
