import hashlib

import pytest

from glyphatlas.llm import repeats
from tests.llm.cases import empty, messy, messy_rows, prose, texts


def brute(rows):
    """Per row, in the order of (doc_id, text) with nulls first: what op1 asks for."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    seen, out = set(), []
    for doc_id, text in ordered:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            window = raw[s:s + 100]
            if window in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(window)
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in repeats.dedup(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def shared_line(n):
    """A line of 90 bytes between surroundings that differ, and one that two documents share a bit further."""
    line = prose(99, 40)[:90]
    rows = [(i, prose(100 + i, 30) + line + prose(500 + i, 30)) for i in range(n)]
    return rows + [(n + 1, rows[3][1][50:] + "!"), (n + 2, "!" + rows[5][1][:-40])]


def test_matches_brute_force_on_awkward_rows(spark):
    assert rows_of(messy(spark)) == brute([r[:2] for r in messy_rows()])


@pytest.mark.parametrize("hot", [20_000, 1])
def test_contested_and_hot_anchors(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = shared_line(24) + [(90, "abc" * 300), (91, "bca" * 200), (92, prose(1, 400)), (93, prose(1, 400)[300:1200] + prose(2, 40) + prose(1, 400)[100:700])]
    assert rows_of(texts(spark, rows)) == brute(rows)


def test_small_chunks_part_no_group(spark, monkeypatch):
    rows = shared_line(30)
    monkeypatch.setattr(repeats, "CHUNK", 500)
    got = sorted((tuple(r)[0], tuple(r)[2]) for r in rows_of(texts(spark, rows)))
    assert got == sorted((r[0], r[2]) for r in brute(rows))


def test_maximal_repeats_are_equal_and_complete(spark):
    passage = prose(7, 60)
    rows = [(1, prose(11, 40) + passage), (2, passage + prose(12, 40)), (3, prose(13, 20) + passage[20:] + prose(14, 20)), (4, prose(15, 60))]
    held = {i: t.encode() for i, t in rows}
    found = {}
    for r in repeats.maximal_repeats(texts(spark, rows)).collect():
        found.setdefault((r["repeat"], r["length"]), set()).add((r["doc_id"], r["start"]))
    covered = {i: set() for i in held}
    for (_, length), places in found.items():
        assert length >= 100 and len(places) > 1
        assert len({held[i][s:s + length] for i, s in places}) == 1
        for i, s in places:
            covered[i].update(range(s, s + length))
    for i, raw in held.items():
        want = set()
        for s in range(len(raw) - 99):
            if sum(other.count(raw[s:s + 100]) for other in held.values()) > 1:
                want.update(range(s, s + 100))
        assert covered[i] == want


def test_maximal_repeats_of_hot_anchors(spark, monkeypatch):
    line = prose(99, 60)[:130]  # a line between surroundings that differ, some of which go on alike
    rows = [(i, prose(100 + i, 30) + "xyz"[i % 3] * 4 + line + "uvw"[i % 2] * 5 + prose(500 + i, 30)) for i in range(18)] + shared_line(8)[8:]
    rows += [(50, rows[2][1][40:]), (51, "é" + rows[3][1][:-30]), (52, rows[4][1]), (53, rows[4][1])]

    def groups():
        found = {}
        for r in repeats.maximal_repeats(texts(spark, rows)).collect():
            found.setdefault((r["repeat"], r["length"]), set()).add((r["doc_id"], r["start"]))
        return sorted((length, sorted(places)) for (_, length), places in found.items())

    want = groups()
    assert any(len(places) >= 18 for _, places in want)
    monkeypatch.setattr(repeats, "HOT", 1)
    assert groups() == want


def test_empty_table(spark):
    assert repeats.dedup(empty(spark)).count() == 0
