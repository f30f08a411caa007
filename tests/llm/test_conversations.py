import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from glyphatlas.llm import conversations as cv
from tests.llm.cases import prose

SCHEMA = "conv_id long, turn long, role string, text string, part int, lost boolean, n long, state int, text_sha256 string"
EXTRA = (7, True, 3, 1, "x")
WHITE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def brute(rows):
    """The digest of one conversation by a search over (cost, audit) from the start, with the roles checked by the pattern's own automaton."""
    nothing = hashlib.sha256(b"").hexdigest()
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", nothing)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.strip(WHITE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, best = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, i, state, made = heapq.heappop(heap)
        if (i, state) in best:
            continue
        best[i, state] = audit
        if i == len(rows) and state in ("", "a"):
            break
        for role in ("user", "assistant"):
            if (to := after.get((state, role[0]))) and audit.count("I") < 2 * len(rows) + 2:
                heapq.heappush(heap, (cost + 2, audit + "I", i, to, (*made, role + ":")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, made))
            if faults[i] not in ("blank", "duplicate"):
                more = cost + (faults[i] == "truncated")
                if to := after.get((state, role[:1])):
                    heapq.heappush(heap, (more, audit + "K", i + 1, to, (*made, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    if to := after.get((state, name[0])):
                        heapq.heappush(heap, (more + 2, audit + "R", i + 1, to, (*made, f"{name}:{text}")))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    count = faults.count
    return (gaps, count("blank"), count("duplicate"), count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(made).encode()).hexdigest())


def want(rows):
    hurt, out = damage(rows), []
    for conv in {r[0] for r in rows}:
        out.append((conv, *brute([r[1:] for r in hurt if r[0] == conv])))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def got(spark, rows, partitions=4):
    df = cv.damage_and_repair(spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(partitions))
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted([tuple(r) for r in df.collect()], key=lambda r: (r[0] is not None, r[0] or 0))


def talk(seed, convs, longest):
    draw = random.Random(seed)
    roles = ["user"] * 5 + ["assistant"] * 5 + ["system", "tool", "", None, " ", "User", "ärger"]
    said = ["Yes.", "No!", "why?", "cut off", "", "  \n", None, "Ends. \t\n", "é.", "a\x00b.", "x" * 50]
    rows = []
    for conv in [*range(convs), None]:
        turn = draw.randint(-2, 2)
        for i in range(draw.randint(1, longest)):
            role = draw.choice(roles) if draw.random() < 0.4 else ("user", "assistant")[i % 2]
            text = draw.choice(said) if draw.random() < 0.4 else prose(draw.randint(0, 10**6), 4) + "."
            rows.append((conv, None if draw.random() < 0.05 else turn, role, text))
            turn += draw.choice([0, 1, 1, 1, 2])
    return rows


# a search that settles each (place, state) at its least (cost, audit) is right: audits that lead there go on alike
@pytest.mark.parametrize("seed", range(2))
def test_same_as_brute_force(spark, seed):
    rows = talk(seed, 150, 14)
    assert got(spark, rows) == want(rows)


def test_conversations_over_many_ranges_and_stretches(spark, monkeypatch):
    monkeypatch.setattr(cv, "PIECE", 64)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        rows = talk(9, 3, 6) + [(5, t, r, x) for t, (_, _, r, x) in enumerate(talk(10, 0, 700))] + talk(11, 40, 5)[:100]
        assert got(spark, rows, 7) == want(rows)
        laid = cv.laid_out(cv.damaged(spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)))
        assert len(cv.crossings(laid)) > 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_third_of_all_rows_is_one_row(spark):
    rows = talk(3, 40, 6) + [(1, 1, "user", "Same.")] * 120 + [(None, None, None, None)] * 60
    assert got(spark, rows) == want(rows)


def test_stretches_of_a_long_portion(monkeypatch):
    import pyarrow as pa

    rows = [r for r in damage(talk(4, 0, 900))]
    table = pa.table({
        "part": pa.array([0] * len(rows), pa.int32()), "lost": [False] * len(rows), "conv": [1] * len(rows), "turn": pa.array([r[1] for r in rows], pa.int64()),
        "role": [r[2] for r in rows], "text": [r[3] for r in rows], "blank": [not r[3].strip(WHITE) for r in rows],
        "duplicate": [i % 7 == 0 and bool(r[3].strip(WHITE)) for i, r in enumerate(rows)], "truncated": [i % 5 == 1 for i in range(len(rows))]})
    p = cv.Portions(table, np.zeros(1, np.int64), False, False)
    end, entry = cv.with_inserts(cv.DONE), np.zeros(1, np.int64)
    whole = cv.paths(p, end, entry, True)
    monkeypatch.setattr(cv, "TOGETHER", 50)
    for a, b in zip(whole, cv.paths(p, end, entry, True), strict=True):
        assert a.tolist() == b.tolist()
    batches = table.slice(0, 400).to_batches(max_chunksize=30) + table.slice(400).to_batches(max_chunksize=70)
    assert [q.rows.num_rows for q in cv.portions(iter(batches))] == [len(rows)]


def test_ranks_order_whole_audits():
    letter = np.array([3, 1, 0, 3, 1, 1, 0, 3, 0])
    target = np.array([1, 2, 2, 4, 5, 6, 6, 8, 8])
    _, steps, _, rank = cv.least_paths(letter, target, np.arange(9))
    audits = ["KD", "D", "", "KDD", "DD", "D", "", "K", ""]
    assert steps.tolist() == [len(a) for a in audits]
    assert np.argsort(rank, kind="stable").tolist() == sorted(range(9), key=lambda i: audits[i])


def test_edits_give_the_repaired_text(spark):
    rows = talk(6, 30, 8)
    frame = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
    edits = cv.repaired(cv.damaged(frame)).orderBy("part", "nth").collect()
    for conv, *_, audit, digest in want(rows):
        own = [e for e in edits if e["conv_id"] == conv]
        assert "".join(e["edit"] for e in own) == audit
        assert hashlib.sha256("\n".join(f"{e['role']}:{e['text']}" for e in own if e["edit"] != "D").encode()).hexdigest() == digest


def test_empty_table_and_dropped_conversations(spark):
    assert got(spark, []) == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert got(spark, [(gone, 0, "user", "Hello.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
