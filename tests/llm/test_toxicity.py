import random
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from glyphatlas.llm import toxicity
from tests.llm.cases import empty, messy, messy_rows, prose

TERMS = ["idiot", "scum", "disgusting", "worthless", "clown"]


def edits(a, b):
    """Optimal string alignment: insertions, deletions, substitutions and neighbours that change places."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_matches_edit_distance():
    draw, words = random.Random(1), []
    for _ in range(1500):
        w = list(draw.choice(TERMS))
        for _ in range(draw.randint(0, 3)):
            at = draw.randrange(len(w)) if w else 0
            kind = draw.randrange(4)
            if kind == 0:
                w.insert(at, draw.choice("aeidost"))
            elif w and kind == 1:
                w[at] = draw.choice("aeidost")
            elif w and kind == 2:
                del w[at]
            elif at + 1 < len(w):
                w[at], w[at + 1] = w[at + 1], w[at]
        words.append("".join(w) or "x")
    data = pa.array(["".join(words)])
    from glyphatlas.llm.common import utf8
    raw, _ = utf8(data)
    ends = [0]
    for w in words:
        ends.append(ends[-1] + len(w))
    import numpy as np
    got = toxicity.Automata(TERMS).distances(toxicity._LETTER[raw], np.array(ends[:-1]), np.array(ends[1:]))
    limit = lambda t: 2 if len(t) >= toxicity.LONG else 1
    want = [min([e for t in TERMS if (e := edits(w, t)) <= limit(t)], default=9) for w in words]
    assert got.tolist() == want


def test_automaton_knows_the_letters_of_every_script():
    terms = ["élève", "dégénéré", "дурак", "мерзавец", "βλάκας", "حقيراً", "愚か者だ", "क्षुद्रबुद्धि", "idiot"]
    draw, words = random.Random(2), list(terms)
    for _ in range(1500):
        w = list(draw.choice(terms))
        for _ in range(draw.randint(0, 3)):
            at, kind = draw.randrange(len(w)), draw.randrange(4)
            if kind == 0:
                w.insert(at, draw.choice("éдуβ愚ы"))
            elif kind == 1:
                w[at] = draw.choice("éдуβ愚ы")
            elif kind == 2 and len(w) > 1:
                del w[at]
            elif at + 1 < len(w):
                w[at], w[at + 1] = w[at + 1], w[at]
        words.append("".join(w))
    automata = toxicity.Automata(terms)
    codes, offsets = toxicity._codes(pa.array(words))
    assert "".join(map(chr, codes)) == "".join(words)
    got = automata.distances(automata.classes(codes), offsets[:-1], offsets[1:])
    limit = lambda t: 2 if len(t) >= toxicity.LONG else 1
    want = [min([e for t in terms if (e := edits(w, t)) <= limit(t)], default=9) for w in words]
    assert got.tolist() == want and got[:len(terms)].max() == 0


def test_terms_of_every_script_count_in_their_context():
    terms = ["élève", "дурак", "βλάκας", "愚か者だ", "क्षुद्र"]
    rows = ["un élève", "ты—дурак…", "ДУРАК и дурк", "ΒΛΆΚΑΣ!", "彼は、愚か者だ。", "वह क्षुद्र है", "«дурак»", "ду€ак", "дурик"]
    found = toxicity.context_counts(pa.array([r.lower() for r in rows]), toxicity.Automata(terms), ("обычный", "дурик"))
    assert found["exact"].tolist() == [1, 1, 1, 1, 1, 1, 1, 0, 0]
    assert found["misspelled"].tolist() == [0, 0, 1, 0, 0, 0, 0, 1, 0]
    assert found["quoted"].tolist() == [0, 0, 0, 0, 0, 0, 1, 0, 0]


def test_learns_and_finds_terms_of_other_scripts(spark):
    docs, labels = labelled(spark)
    other = dict(zip(TERMS, ["дурак", "сволочь", "élèvé", "βλάκας", "क्षुद्र"], strict=True))
    text = F.col("text")
    for a, b in other.items():
        text = F.regexp_replace(text, f"\\b{a}\\b", b)
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.upper(text)).otherwise(text))
    held = [r for r in toxicity.toxicity(docs, labels).join(labels, "doc_id").collect() if r["held_out"]]
    assert len(held) > 50 and all(r["predicted"] == r["toxic"] for r in held)


def counts(*rows, ordinary=()):
    found = toxicity.context_counts(pa.array(list(rows)), toxicity.Automata(TERMS), ordinary)
    return {k: v.tolist() for k, v in found.items()}


def test_context_windows():
    got = counts("what an idiot", "you idiot", 'he called them "idiot" there', "an id1ot and a scumm", "IDIOT, Clown!", "", "sscum is ordinary", ordinary=("sscum",))
    assert got["exact"] == [1, 1, 1, 0, 2, 0, 0]
    assert got["misspelled"] == [0, 0, 0, 2, 0, 0, 0]
    assert got["quoted"] == [0, 0, 1, 0, 0, 0, 0]
    assert got["weight"][1] > got["weight"][0] > got["weight"][2]
    # a word of another row is no context
    assert counts("you", "idiot")["weight"] == counts("idiot", "idiot")["weight"][:0] + [0.0, 1.0]


def labelled(spark, n=300):
    draw, rows, labels = random.Random(5), [], []
    for i in range(n):
        words = prose(1000 + i, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(TERMS))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    # a toxic text with many copies must not teach its ordinary words
    rows += [(n + j, prose(77, 60) + " scum") for j in range(40)]
    labels += [(n + j, 1, 1) for j in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_terms_and_scores_held_out_rows(spark):
    docs, labels = labelled(spark)
    out = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r["held_out"]]
    assert len(held) > 50 and all(r["predicted"] == r["toxic"] and 0 <= r["score"] <= 1 for r in held)
    known = toxicity.known_labels(labels, 3, 1)
    terms, _ = toxicity.learn_lexicon(toxicity.word_counts(docs, known), known)
    assert set(terms) == set(TERMS)


def test_many_terms_and_short_ones_are_all_learned(spark):
    terms = [f"zq{chr(97 + i // 26)}{chr(97 + i % 26)}xv" for i in range(640)] + ["zqj"]
    rows, labels = [], []
    for i in range(240):
        words = prose(i, 40).split()
        if i % 2:
            words += [w for t in terms for w in (t, f"w{(i * 7 + len(words)) % 50}")] + [f"own{i}"]
            draw = random.Random(i)
            draw.shuffle(words)
        rows.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, 1, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    known = toxicity.known_labels(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), 3, 1)
    found, _ = toxicity.learn_lexicon(toxicity.word_counts(docs, known), known)
    assert set(terms) <= set(found)


def test_short_terms_match_exactly_only():
    automaton = toxicity.Automata(["zqj", "zqjk"])
    words = ["zqj", "zqa", "zq", "zqjk", "zqja", "qjk"]
    codes, offsets = toxicity._codes(pa.array(words))
    assert automaton.distances(automaton.classes(codes), offsets[:-1], offsets[1:]).tolist() == [0, 9, 9, 0, 1, 1]


def test_held_out_labels_are_not_read(spark):
    docs, labels = labelled(spark)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, flipped).collect()}
    assert a == b


def test_awkward_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(messy(spark), labels).collect()
    assert len(out) == len(messy_rows()) and all(r["predicted"] == 0 for r in out)
    none = labels.where("false")
    assert toxicity.toxicity(empty(spark), none).count() == 0
