import math
import re
from collections import Counter

import pyarrow as pa

from glyphatlas.llm import fertility, tokens
from glyphatlas.llm.common import Words, utf8
from tests.llm.cases import empty, messy, messy_rows, prose


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_base_counts_match_brute_force(spark):
    got = fertility.judge(messy(spark)).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r["doc_id"]), *[r[c] for c in columns]) for r in got) == sorted((str(x[0]), *base(x[1])) for x in messy_rows())
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_tokens_match_the_library():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary(tokens.PIECE_BPE))
    rows = [prose(i, 50) for i in range(5)] + ["", "日本語 テスト ∮∮", "one", "▁odd mark"]
    data, offsets = utf8(pa.array(rows))
    got = fertility.fertility_counts(tokens.vocabulary(tokens.PIECE_BPE), data, Words(data, offsets, lower=False))
    for i, text in enumerate(rows):
        ids = [x for w in text.split() for x in library.encode(w)]
        counts = Counter(ids)
        assert got["n_tokens"][i] == len(ids) and got["n_byte_tokens"][i] == sum(3 <= x < 259 for x in ids)
        assert math.isclose(got["entropy"][i], -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values()) if ids else 0, abs_tol=1e-9)


def test_bands_reject_what_a_vocabulary_splits_oddly(spark):
    rows = [(i, prose(i, 100), "en") for i in range(300)]
    rows += [(1000 + i, " ".join(f"{w}###" for w in prose(2000 + i, 100).split()), "en") for i in range(10)]
    rows += [(2000 + i, "".join(c + "̴" for c in prose(3000 + i, 100)), None) for i in range(10)]
    got = {r["doc_id"]: r["kept"] for r in fertility.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sum(got[i] for i in range(300)) >= 290
    assert not any(v for i, v in got.items() if i >= 1000)


def test_scripts():
    data, offsets = utf8(pa.array(["plain words", "слова и слова", "λέξεις", "日本語テスト", ""]))
    assert fertility.script(data, offsets)[:4] == ["script:latin", "script:cyrillic", "script:greek", "script:asian"]


def test_empty_table(spark):
    assert fertility.judge(empty(spark)).count() == 0


def test_empty_languages_do_not_depend_on_batches(spark):
    rows = [(i, prose(i, 70), lang, "a", 1) for i, lang in enumerate(["en", "", " ", None] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    seen = [sorted(map(str, fertility.judge(docs.repartition(n)).collect())) for n in (1, 64)]
    assert seen[0] == seen[1]
    assert {r["language"] for r in fertility.judge(docs).collect()} == {"en", "script:latin"}
