"""Misspelled terms of a lexicon by Levenshtein automata intersected with its trie, scored by context.

1. `learn_lexicon`: all terms that labelled toxic texts use far more often than others, in many texts and contexts, by counts over all
   labelled rows outside the held-out fold. A term needs a fixed share of the toxic texts, so there are no more terms than
   that share of them can hold words.
2. `Automaton`: the trie of the terms, intersected with the automaton of all words within 1 edit of a term (2 edits
   for terms of `LONG` letters or more, none for terms of fewer than `SHORT`; two letters that change places are one edit), made deterministic. All words
   of a batch step through its table together. Words that other labelled texts use as well are no misspellings; only those within reach of a
   term are listed, so their number is bounded by what one or two edits can make of the terms.
3. `measure`: every hit in every whole text counts by its context window: less in quotation marks or beside a reporting
   word, more beside a word of address, less if misspelled.
4. A logistic fit of the labels on these measures gives the score, from at most `MOST_LABELLED` labelled rows (smallest digests of doc_id).

Null or empty texts have no hits. Null labels are left out; without labels of both classes the lexicon is
empty and every score is the share of toxic labels (0 without any). Rows that share a doc_id are scored each on its own text. An
empty table gives no rows.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphatlas.llm.common import doc_texts, held_out, in_pieces, span_hashes, text_mark, utf8
from glyphatlas.session import cut_lineage

MOST_LABELLED = 20_000
LEAST_SUPPORT, LEAST_SHARE = 5, 0.002
LEAST_RATIO = 10.0
SHORT, LONG = 4, 9
TERMS_EACH = 32
WINDOW = 4
REACH = 60
QUOTED, ADDRESSED, MISSPELLED = 0.15, 1.25, 0.8

# Words that address someone, and words that report what others said.
ADDRESS = ("you", "your", "yours", "youre", "u", "ur", "tu", "te", "toi", "vous", "du", "dich", "dir", "ihr", "usted", "ustedes", "eres")
REPORT = (
    "said", "says", "say", "called", "calls", "wrote", "writes", "quote", "quoted", "quoting", "word", "term", "slur", "insult", "dit",
    "mot", "sagte", "wort", "dijo", "palabra",
)


# --- automaton -----------------------------------------------------------------------------------------


class Automaton:
    """Deterministic table over the letters a-z, every other character of the terms, and one class for all that stand in no term.

    Classes are 0-25 for a-z, 26 for characters of no term, and 27 onwards for `letters`, the other characters of all terms;
    `column` leads from these classes to the columns of the table, which has the characters of its own terms only. A state stands for a set of (trie node, letter that is still to come of two that changed places, edits spent); `distance[state]` is the smallest number of edits to a term
    that the word read so far is within, or 9. State 0 is dead, state 1 the start.
    """

    def __init__(self, terms: list[str], letters: str = ""):
        own = sorted({c for term in terms for c in term if not "a" <= c <= "z"})
        column = {c: 27 + i for i, c in enumerate(own)} | {chr(97 + i): i for i in range(26)}
        children: list[dict[int, int]] = [{}]
        end: list[int] = [-1]
        for term in terms:
            node = 0
            for c in term:
                k = column[c]
                if k not in children[node]:
                    children[node][k] = len(children)
                    children.append({})
                    end.append(-1)
                node = children[node][k]
            end[node] = 2 if len(term) >= LONG else 1 if len(term) >= SHORT else 0
        spare = end[:]  # most edits that any term below a node allows
        for node in range(len(children) - 1, -1, -1):
            spare[node] = max([end[node], *(spare[c] for c in children[node].values())])

        def settled(found: dict[tuple[int, int], int]) -> frozenset:
            """With every letter of the terms that may be left out."""
            todo = list(found.items())
            while todo:
                (node, due), e = todo.pop()
                if due >= 0 or found[node, due] < e:
                    continue
                for child in children[node].values():
                    if e + 1 <= spare[child] and e + 1 < found.get((child, -1), 9):
                        found[child, -1] = e + 1
                        todo.append(((child, -1), e + 1))
            return frozenset(found.items())

        def steps(node: int, due: int, e: int, k: int) -> Iterator[tuple[tuple[int, int], int]]:
            """Where one more character leads."""
            if due >= 0:
                if due == k:
                    yield (node, -1), e
                return
            for letter, child in children[node].items():
                yield (child, -1), e + (letter != k)
                if letter != k and k in children[child]:
                    yield (children[child][k], letter), e + 1
            yield (node, -1), e + 1

        def told_apart(state: frozenset) -> set[int]:
            """The letters that lead elsewhere than a character of no term."""
            known = {due for (_, due), _ in state if due >= 0}
            for (node, due), _ in state:
                if due < 0:
                    known.update(children[node], *(children[child] for child in children[node].values()))
            return known

        start = settled({(0, -1): 0}) if terms else frozenset()
        number = {frozenset(): 0, start: 1}
        table, distance = [[0] * (27 + len(own))], [9]
        queue = [start]
        for state in queue:
            row = [0] * (27 + len(own))
            for k in (26, *sorted(told_apart(state))):
                found: dict[tuple[int, int], int] = {}
                for (node, due), e in state:
                    for to, cost in steps(node, due, e, k):
                        if cost <= spare[to[0]] and cost < found.get(to, 9):
                            found[to] = cost
                goal = settled(found)
                if goal not in number:
                    number[goal] = len(number)
                    queue.append(goal)
                if k == 26:
                    row = [number[goal]] * len(row)
                row[k] = number[goal]
            table.append(row)
            distance.append(min([9, *(e for (node, due), e in state if due < 0 and e <= end[node])]))
        self.column = np.array([*range(27), *(column.get(c, 26) for c in letters)], np.int32)
        self.table = np.array(table, np.int32)
        self.distance = np.array(distance, np.int8)

    def distances(self, letters: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For each word (a span of letter classes) its edits to the nearest term, or 9."""
        out = np.full(len(start), 9, np.int8)
        alive = np.arange(len(start))
        state = np.ones(len(start), np.int32)
        at, left = start.copy(), end - start
        while len(alive):
            done = left == 0
            out[alive[done]] = self.distance[state[done]]
            go = ~done
            alive, at, left = alive[go], at[go], left[go]
            state = self.table[state[go], self.column[letters[at]]]
            go = state > 0
            alive, at, left, state = alive[go], at[go] + 1, left[go] - 1, state[go]
        return out


class Automata:
    """Automata of `TERMS_EACH` terms each, in alphabetical order, so that terms with a common beginning share states and
    the tables grow in proportion to the terms."""

    def __init__(self, terms: list[str]):
        terms = sorted(set(terms))
        self.letters = "".join(sorted({c for term in terms for c in term if not "a" <= c <= "z"}))
        self.parts = [Automaton(terms[i:i + TERMS_EACH], self.letters) for i in range(0, len(terms), TERMS_EACH)]

    @functools.cached_property
    def _class(self) -> np.ndarray:
        codes = [ord(c) for c in self.letters]
        out = np.full(max([256, *(c + 2 for c in codes)]), 26, np.int32)  # the last place stands for all code points beyond
        out[:256] = _LETTER
        out[codes] = 27 + np.arange(len(codes))
        return out

    def classes(self, codes: np.ndarray) -> np.ndarray:
        """The letter class of every code point."""
        return self._class[np.minimum(codes, len(self._class) - 1)]

    def distances(self, letters: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.full(len(start), 9, np.int8)
        for part in self.parts:
            np.minimum(out, part.distances(letters, start, end), out=out)
        return out


# --- words and contexts ----------------------------------------------------------------------------------

_LETTER = np.full(256, 26, np.uint8)
_LETTER[97:123] = np.arange(26)
# A word as the lexicon learns it; context windows also take digits and signs that mask a letter as part of a word.
WORD = r"([\p{L}\p{M}]+(?:\p{Cf}[\p{L}\p{M}]+)*)"


@functools.cache
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """For every code point, whether it is part of a word, and whether it masks a letter if it stands inside one."""
    kinds = [unicodedata.category(chr(c)) for c in range(128, 0x110000)]
    part, masks = np.zeros(0x110000, bool), np.zeros(0x110000, bool)
    part[97:123] = part[48:58] = True
    part[128:] = [k[0] in "LMN" for k in kinds]
    masks[128:] = [k[0] == "S" or k == "Cf" for k in kinds]
    masks[[ord(c) for c in "@$*¡"]] = True
    return part, masks


def _codes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of a string column in one piece, and the offset where each row begins (one more for the end)."""
    data, offsets = utf8(column)
    lead = (data & 0xC0) != 0x80
    kept = np.concatenate([[0], np.cumsum(lead)])
    codes = data[lead].astype(np.int32)
    wide = np.flatnonzero(codes >= 0xC0)
    if len(wide):
        at, first = np.flatnonzero(lead)[wide], codes[wide]
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        b, c, d = (padded[at + i].astype(np.int32) & 0x3F for i in (1, 2, 3))
        two, three = (first & 0x1F) << 6 | b, (first & 0x0F) << 12 | b << 6 | c
        four = np.minimum((first & 0x07) << 18 | b << 12 | c << 6 | d, 0x10FFFF)
        codes[wide] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
    return codes, kept[offsets]


def _word_list(words: tuple[str, ...]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(w) for w in words])
    return np.sort(span_hashes(data, ends - [len(w) for w in words], ends))


def context_counts(column: pa.Array, automaton: Automata, ordinary: tuple[str, ...] = ()) -> dict[str, np.ndarray]:
    """Per row: words, exact hits, misspelled hits, quoted hits, and the sum of the hits' weights."""
    data, offsets = _codes(pc.utf8_lower(column))
    rows = len(offsets) - 1
    marks = (data == 0x22) | (data == 0xAB) | (data == 0xBB) | (data >= 0x2018) & (data <= 0x201F)
    in_word, masking = _kinds()
    part = in_word[data]
    if len(data) > 2:  # a sign that masks a letter
        part[1:-1] |= masking[data[1:-1]] & part[:-2] & part[2:]
    owner_cut = np.zeros(len(data) + 1, bool)
    owner_cut[offsets] = True
    before = np.concatenate([[False], part[:-1]])
    start = np.flatnonzero(part & (~before | owner_cut[:-1]))
    behind = np.concatenate([part[1:], [False]])
    end = np.flatnonzero(part & (~behind | owner_cut[1:])) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    out = {"n_words": np.bincount(row, minlength=rows)}
    edits = automaton.distances(automaton.classes(data), start, end)
    hit = np.flatnonzero(edits < 9)
    if len(ordinary) and len(hit):
        hit = hit[(edits[hit] == 0) | ~np.isin(_local_hashes(data, start[hit], end[hit]), _word_list(ordinary))]
    # context: words on either side, and quotation marks on both sides of the hit within reach and row
    lo, hi = np.maximum(hit - WINDOW, 0), np.minimum(hit + WINDOW + 1, len(start))
    first = np.searchsorted(row, np.arange(rows + 1))
    lo, hi = np.maximum(lo, first[row[hit]]), np.minimum(hi, first[row[hit] + 1])

    def near(words: tuple[str, ...]) -> np.ndarray:
        around = np.unique(np.concatenate([np.arange(a, b) for a, b in zip(lo, hi, strict=True)])) if len(hit) else np.zeros(0, np.int64)
        known = np.zeros(len(start) + 1, np.int64)
        if len(around):
            spans = _local_hashes(data, start[around], end[around])
            listed = _word_list(words)
            spot = np.minimum(np.searchsorted(listed, spans), len(listed) - 1)
            known[around + 1] = listed[spot] == spans
        total = np.cumsum(known)
        return total[hi] > total[lo]

    quotes = np.concatenate([[0], np.cumsum(marks)])
    left = np.maximum(start[hit] - REACH, offsets[row[hit]])
    right = np.minimum(end[hit] + REACH, offsets[row[hit] + 1])
    quoted = (quotes[start[hit]] > quotes[left]) & (quotes[right] > quotes[end[hit]]) | near(REPORT)
    addressed = near(ADDRESS) & ~quoted
    weight = np.where(edits[hit] > 0, MISSPELLED, 1.0) * np.where(quoted, QUOTED, 1.0) * np.where(addressed, ADDRESSED, 1.0)
    count = lambda flag: np.bincount(row[hit], weights=flag, minlength=rows)
    out["exact"] = count(edits[hit] == 0).astype(np.int64)
    out["misspelled"] = count(edits[hit] > 0).astype(np.int64)
    out["quoted"] = count(quoted).astype(np.int64)
    out["weight"] = count(weight)
    return out


def _local_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of a few spans without hashing the whole batch."""
    size = end - start
    before = np.cumsum(size) - size
    flat = data[np.repeat(start - before, size) + np.arange(int(size.sum()))]
    return span_hashes(flat, before, before + size)


# --- lexicon and score ----------------------------------------------------------------------------------


def known_labels(labels: DataFrame, folds: int, fold: int) -> DataFrame:
    """(known, label): all labelled ids outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("known"), F.col("toxic").cast("int").alias("label"))
    known = known.where(F.col("known").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("known"), folds, fold))
    return known.groupBy("known").agg(F.max("label").alias("label"))


def labelled_sample(known: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """At most `most` of the labelled ids, those with the smallest digests."""
    return known.orderBy(F.xxhash64("known"), "known").limit(most)


def word_counts(texts: DataFrame, known: DataFrame) -> DataFrame:
    """(word, toxic, contexts, other): in how many toxic and other labelled texts a word stands, and after how many
    different words in toxic ones.

    The labelled ids grow with the documents, so they are never broadcast: at every size both sides meet by id, and the narrow side is hashed."""
    seen = texts.join(known.hint("shuffle_hash"), F.col("doc_id") == F.col("known"))
    listed = seen.select("label", F.regexp_extract_all(F.lower("text"), F.lit(WORD), 1).alias("w")).where(F.size("w") > 0)
    texts_of = listed.select("label", F.explode(F.array_distinct("w")).alias("word")).groupBy("word").agg(
        F.count(F.when(F.col("label") == 1, 1)).alias("toxic"), F.count(F.when(F.col("label") == 0, 1)).alias("other"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.struct(
        F.element_at("w", i).alias("word"), F.when(i > 1, F.element_at("w", F.greatest(i - 1, F.lit(1)))).otherwise("").alias("before")))
    toxic = listed.where("label = 1").select(F.explode(F.array_distinct(pairs)).alias("p")).select("p.word", "p.before")
    contexts = toxic.distinct().groupBy("word").agg(F.count(F.lit(1)).alias("contexts"))
    return texts_of.join(contexts, "word", "left").select("word", "toxic", F.coalesce("contexts", F.lit(0)).alias("contexts"), "other")


def learn_lexicon(counts: DataFrame, known: DataFrame) -> tuple[list[str], tuple[str, ...]]:
    """The terms, by the ratio of their shares among toxic and other texts, and the ordinary words near them.

    A term stands in `LEAST_SUPPORT` labelled toxic texts and `LEAST_SHARE` of them, after as many different words, so that
    neither the words of a long text nor those of a text with many copies count. An ordinary word is within the
    automaton's reach, but no more frequent in toxic texts than elsewhere.
    """
    found = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    n1, n0 = found.get(1, 0), found.get(0, 0)
    if not n1 or not n0:
        return [], ()
    support = F.least("toxic", "contexts")
    ratio = ((support + 0.5) / n1) / ((F.col("other") + 0.5) / n0)
    best = counts.where(support >= max(LEAST_SUPPORT, LEAST_SHARE * n1)).withColumn("ratio", ratio).where(F.col("ratio") >= LEAST_RATIO)
    terms = sorted(r["word"] for r in best.select("word").collect())
    automaton = Automata(terms)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, offsets = _codes(batch.column(0))
            edits = automaton.distances(automaton.classes(codes), offsets[:-1], offsets[1:])
            yield batch.filter(pa.array((edits > 0) & (edits < 9)))

    usual = counts.where((F.col("other") > 0) & (ratio < LEAST_RATIO)).select("word", "other").mapInArrow(near, "word string, other long")
    return terms, tuple(sorted(r["word"] for r in usual.select("word").collect()))


def measure(docs: DataFrame, terms: list[str], ordinary: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, mark, n_words, exact, misspelled, quoted, weight) of every whole text; `mark` is a hash of the text. The automaton grows with the terms only."""
    automaton = Automata(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, 1 << 20):
            found = context_counts(batch.column(1), automaton, ordinary)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *[pa.array(found[c], pa.int64()) for c in ("n_words", "exact", "misspelled", "quoted")], pa.array(found["weight"], pa.float64())],
                ["doc_id", "mark", "n_words", "exact", "misspelled", "quoted", "weight"])

    lowered = doc_texts(docs).select("doc_id", F.lower("text").alias("text"), text_mark("text").alias("mark"))  # as in the lexicon, in every script
    return lowered.mapInArrow(run, "doc_id long, mark long, n_words long, exact long, misspelled long, quoted long, weight double")


@dataclass(frozen=True)
class Logistic:
    """score = 1 / (1 + exp(-(b0 + b1 * log(1 + weight) + b2 * log(1 + weight per hundred words))))."""

    b: tuple[float, float, float]


def fit(rows: np.ndarray, labels: np.ndarray, ridge: float = 0.01) -> Logistic:
    """Newton steps on (1, log1p(weight), log1p(density)); the intercept is free, the others are held by `ridge` and not negative."""
    if not len(labels) or labels.min() == labels.max():
        share = min(max(float(labels.mean()) if len(labels) else 0.0, 1e-6), 1 - 1e-6)
        return Logistic((float(np.log(share / (1 - share))), 0.0, 0.0))
    b = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ b, -30, 30)))
        hold = np.array([1e-6, ridge, ridge]) * len(labels) * 0.01
        slope = rows.T @ (labels - p) - hold * b
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(hold)
        step = np.linalg.solve(curve, slope)
        b = b + step
        if np.abs(step).max() < 1e-9:
            break
    if min(b[1:]) < 0:  # one measure at a time, if the two fight each other
        keep = [0, 1]
        slim = fit(np.concatenate([rows[:, keep], np.zeros((len(rows), 1))], axis=1), labels, ridge) if rows[:, 2].any() else Logistic((float(b[0]), 0.0, 0.0))
        return Logistic((slim.b[0], max(slim.b[1], 0.0), 0.0))
    return Logistic(tuple(float(x) for x in b))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, folds: int = 3, fold: int = 1, most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted, exact, misspelled, quoted, mark) for every row; labels of the held-out fold are never read."""
    everyone = cut_lineage(known_labels(labels, folds, fold))
    sample = cut_lineage(labelled_sample(everyone, most))
    terms, ordinary = learn_lexicon(cut_lineage(word_counts(doc_texts(docs), everyone)), everyone)
    measured = cut_lineage(measure(docs, terms, ordinary))
    density = F.log1p(100 * F.col("weight") / F.greatest("n_words", F.lit(1)))
    known = measured.join(F.broadcast(sample), F.col("doc_id") == F.col("known"))
    got = known.groupBy("known").agg(F.max("label").alias("label"), F.max(F.log1p("weight")).alias("a"), F.max(density).alias("b"))
    rows = got.orderBy("known").limit(most).toPandas()  # no more than the sample
    model = fit(np.column_stack([np.ones(len(rows)), rows["a"], rows["b"]]).astype(np.float64), rows["label"].to_numpy(np.float64))
    odds = F.lit(model.b[0]) + F.lit(model.b[1]) * F.log1p("weight") + F.lit(model.b[2]) * density
    scored = measured.withColumn("score", 1 / (1 + F.exp(-odds)))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"), "exact", "misspelled", "quoted", "mark")
