import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from glyphatlas.llm import token_codes, tokens
from glyphatlas.llm.common import in_pieces, utf8
from tests.llm.cases import empty, messy, messy_rows, prose


@pytest.mark.parametrize("n", [0, 1, 63, 64, 511, 512, 513, 3000])
def test_random_access_and_slices(n):
    draw = np.random.default_rng(n)
    ids = draw.choice(np.array([0, 1, 255, 256, 4095, 50256, 65536, 1 << 31, (1 << 63) + 5], np.uint64), n)
    reader = token_codes.Reader(token_codes.encode(ids))
    assert reader.n == n
    assert [reader.access(i) for i in range(n)] == ids.tolist()
    for a, b in ((0, n), (n // 3, n // 2), (n, n), (max(0, n - 1), n)):
        assert reader.ids(a, b).tolist() == ids[a:b].tolist()
    with pytest.raises(IndexError):
        reader.access(n)


def library_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary(tokens.BYTE_BPE)).encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts():
    rows = [prose(i, 80) for i in range(20)] + [
        "", " ", "  a  b ", " a\n\n b\t c", "x  y", "<|endoftext|> it's he'll 12.5,ab", "…. a é. ç,", "\n", "a .b", "ÀÿŒ.x ×. ÷:", "a b c", "tab\t.x", "\r\n a",
        "don't. we'VE; 3.14!? “q”. end", "   a", "a\u0085b", "naïve.café:x", "日本語。 テスト", "emoji 😀. x",
        "a\n\nb", "a\n\n\nb.", "\n\tx", "a \nb", "a\n b\t\t1", "\t\t日\n\n",
    ]
    batch = pa.record_batch({"text": pa.array(rows)})
    got = []
    for piece in in_pieces([batch], 600):
        flat, n = tokens.byte_bpe_ids(tokens.vocabulary(tokens.BYTE_BPE), *utf8(piece.column(0)))
        ends = np.cumsum(n)
        got += [flat[e - k:e].tolist() for e, k in zip(ends, n, strict=True)]
    assert got == [library_ids(t) for t in rows]


def test_round_trip_through_files(spark):
    docs = messy(spark)
    path = token_codes.scratch(spark, "codes")
    token_codes.write_codes(docs, path)
    got = token_codes.read_codes(spark, path).collect()
    want = sorted(((i is not None, i or 0), library_ids(t) + [2]) for i, t in [r[:2] for r in messy_rows()])
    assert len(got) == len(want)
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] or 0 for r in got] == [k[1] for k, _ in want]
    at = 0
    sums = []
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        sums.append((r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]))
    assert sorted(sums) == sorted((k[1], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, ids in want)


def test_small_blobs(spark, monkeypatch):
    monkeypatch.setattr(token_codes, "BLOB_TOKENS", 50)
    docs = messy(spark)
    path = token_codes.scratch(spark, "codes")
    token_codes.write_codes(docs, path)
    assert {r["doc_id"] for r in token_codes.read_codes(spark, path).collect()} == {r[0] for r in messy_rows()}


def test_empty_table(spark):
    path = token_codes.scratch(spark, "codes")
    token_codes.write_codes(empty(spark), path)
    assert token_codes.read_codes(spark, path).count() == 0


def test_memory_does_not_grow_with_the_batch():
    rows = [prose(i, 80) for i in range(2000)]
    rows = [" ".join(rows[i:i + 10]) for i in range(0, 2000, 10)] * 8
    batch = pa.record_batch({"doc_id": pa.array(range(len(rows))), "text": pa.array(rows), "part": pa.array([0] * len(rows))})
    assert batch.column(1).nbytes > 4 << 20
    list(token_codes.blobs(iter([batch.slice(0, 10)])))  # the vocabulary is there
    tracemalloc.start()
    try:
        got = list(token_codes.blobs(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(b.column(4)[0].as_py() for b in got) > 0
    assert peak < 120 << 20
