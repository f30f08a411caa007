import hashlib
from collections import Counter

import numpy as np
import pytest

from glyphatlas.llm import token_alignment as ta
from glyphatlas.llm import tokens
from tests.llm.cases import empty, messy, messy_rows, prose, texts


def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokens.vocabulary(tokens.BYTE_BPE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary(tokens.PIECE_BPE))


def encoded(a, b, text):
    """[(id, bytes)] of both libraries over the whole text, or nothing if the bytes are not given back."""
    if not text:
        return [], []
    byte_a, byte_b = tokens.byte_bpe_bytes(tokens.vocabulary(tokens.BYTE_BPE)), tokens.piece_bytes(tokens.vocabulary(tokens.PIECE_BPE))
    xs = [(i, byte_a[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
    ys = [(i, byte_b[i]) for i in b.encode(text)]
    want = (" " + text).encode()
    if b"".join(w for _, w in xs) != want or b"".join(w for _, w in ys) != want:
        return [], []
    return xs, ys


def brute(rows):
    a, b = libraries()
    found, counts = [], Counter()
    for i, text in rows:
        xs, ys = encoded(a, b, text)
        ends = []
        for side in (xs, ys):
            at, out = 0, []
            for t, w in side:
                at += len(w)
                out.append((at, t))
            ends.append(out)
        links = [(x, y) for e, x in ends[0] for f, y in ends[1] if e == f] if len(xs) < 400 else [
            (dict(ends[0])[e], dict(ends[1])[e]) for e in sorted(dict(ends[0]).keys() & dict(ends[1]).keys())]
        counts.update(links)
        both = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        parts, low = [], 0
        for e in both:
            parts.append("|".join(",".join(str(t) for f, t in side if low < f <= e) for side in ends))
            low = e
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if xs else ""
        found.append((i, len(xs), len(ys), len(both), links, digest))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    return sorted([(i, n_a, n_b, g, len(ls), sum(counts[p] == most[p[1]] for p in ls), sum(counts[p] for p in ls), d) for i, n_a, n_b, g, ls, d in found], key=key)


def rows_of(df):
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    return sorted([tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()], key=key)


ODD = [
    " ", "   ", "a ", " a", "a  ", "  a  b   c ", "a\nb\n\n", "\n", "\t", "a▁b", "▁", "<|endoftext|> x <s> </s> <unk>", "<0x0A> y", "naïve café", "日本語。 テスト", "emoji 😀 x",
    "a\x00b", "a b", "ﬁ é é", "don't we'VE 12.5", "x" * 300, "e " * 200, "\r\n a", "a　b", "​", "  ", "one▁ two",
]


def test_same_as_brute_force(spark):
    rows = [r[:2] for r in messy_rows() if len(r[1] or "") < 3000]
    assert rows_of(ta.scored(messy(spark).where("coalesce(length(text), 0) < 3000"))) == brute(rows)


def test_odd_texts(spark):
    rows = list(enumerate(ODD))
    assert rows_of(ta.scored(texts(spark, rows).repartition(3))) == brute(rows)


def test_windows_do_not_matter(monkeypatch):
    draw = np.random.default_rng(5)
    a, b = np.cumsum(draw.integers(1, 9, 4000)), np.cumsum(draw.integers(1, 9, 4000))
    a, b = np.append(a[a < b[-1]], b[-1]), b
    ids_a, ids_b = list(range(len(a))), list(range(len(b)))
    whole = list(ta.groups(ids_a, ids_b, a, b))
    assert list(ta.groups(ids_a, ids_b, a, b, 37)) == whole
    assert sum((g for g, _ in whole), []) == ids_a and sum((g for _, g in whole), []) == ids_b
    assert [(int(a[x]), int(b[y])) for x, y in (ta.links(*g) for g in whole)] == [(e, e) for e in sorted(set(a.tolist()) & set(b.tolist()))]
    assert all(len(set(a[g].tolist()) & set(b[h].tolist())) == 1 for g, h in whole)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_of_odd_characters(spark, seed):
    draw = np.random.default_rng(seed)
    parts = [" ", "  ", "a", "the", "é", "\n", "ß", "▁" if seed == 2 else "_", "日", "1", ".", "'s", "ing", "\t", "<s>", "😀"]
    rows = [(i, "".join(draw.choice(parts, draw.integers(0, 60)))) for i in range(120)]
    assert rows_of(ta.scored(texts(spark, rows))) == brute(rows)


def test_a_long_text_in_windows(spark, monkeypatch):
    rows = [(1, prose(3, 400)), (2, None), (3, "")]
    want = brute(rows)
    monkeypatch.setattr(ta, "WINDOW", 101)
    assert rows_of(ta.scored(texts(spark, rows))) == want


def test_pairs_stay_below_the_bound_and_empty_table(spark):
    found = ta.pair_counts(ta.align(messy(spark)))
    assert 0 < found.count() <= ta.most_pairs(tokens.vocabulary(tokens.BYTE_BPE), tokens.vocabulary(tokens.PIECE_BPE))
    assert ta.scored(empty(spark)).count() == 0
