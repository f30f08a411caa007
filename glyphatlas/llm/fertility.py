"""Tokeniser fertility as a quality rule: how a public vocabulary splits a text tells prose from junk.

Per whole text: code points per token, share of byte-fallback tokens, and entropy of the tokens against what
a text of that many tokens can reach. Each language (or, where none is given, each script) has its own bands for
each doubling of the number of words, since short texts scatter more. They are taken from all documents that pass the
base rules: from the median down `LOW` and up `HIGH` times the distance to the quartile, on counts of binned
values, so that they are exact for the bins, need no sample, and a language that holds a third of the rows costs a
few thousand counts like any other.

Null or empty texts have no words and fail the base rules. A size with fewer than `LEAST` documents is judged by the
bands of its language, a language with fewer by those of all documents. Repeated rows count as often as they occur; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphatlas.llm import tokens
from glyphatlas.llm.common import MIX, Words, in_pieces, mixed, null_safe_join, span_hashes, utf8
from glyphatlas.session import cut_lineage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LOW, HIGH = 4.0, 8.0
LEAST = 100
BINS = 1024
# The range that the bins of each measure span; values outside count in the outermost bins.
MEASURES = {"chars_per_token": (0.0, 8.0), "byte_share": (0.0, 0.5), "entropy_ratio": (0.0, 2.0)}
# No band is narrower than this on either side of the median.
FLOOR = {"chars_per_token": 0.04, "byte_share": 0.02, "entropy_ratio": 0.015}

_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
_CONTINUES = (np.arange(256) & 0xC0) == 0x80
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
# First code points of the scripts told apart, by the lead byte or bytes of UTF-8.
_SCRIPTS = {"latin": (0x41, 0xC3), "greek": (0xCE, 0xCF), "cyrillic": (0xD0, 0xD3), "semitic": (0xD7, 0xDB), "indic": (0xE0, 0xE0), "asian": (0xE3, 0xED)}


def base_counts(data: np.ndarray, offsets: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    """The base counts of every row of a batch."""
    rows = len(offsets) - 1

    def per_row(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    # lines: pieces between line feeds, per row
    feeds = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
    ends = np.sort(np.concatenate([offsets[1:], feeds]))
    owner = np.searchsorted(offsets, start, "right") - 1
    owner[owner >= rows] = rows - 1
    first_word = np.searchsorted(words.start, start)
    held = np.append(words.start, len(data) + 1)[first_word] < ends
    start, ends, owner = start[held], ends[held], owner[held]
    owner = words.row[first_word[held]]
    key = mixed(span_hashes(data, start, ends) + owner.astype(np.uint64) * MIX)
    repeats = np.bincount(owner, minlength=rows) - np.bincount(owner[np.unique(key, return_index=True)[1]], minlength=rows)
    # words in 3-word windows that the text holds twice
    n = len(words.hash)
    covered = np.zeros(n + 1, np.int64)
    if n >= 3:
        same = words.row[:n - 2] == words.row[2:]
        at = np.flatnonzero(same)
        row, window = words.shingles(3)
        key = mixed(window + row.astype(np.uint64) * MIX)
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = at[count[back] > 1]
        for i in range(3):
            covered[twice + i] = 1
    total = np.concatenate([[0], np.cumsum(covered[:n])])
    return {
        "n_words": np.diff(words.first), "word_chars": per_row(~_CONTINUES[data] & ~_BLANK[data]), "n_symbols": per_row(_SYMBOL[data]),
        "n_dup_lines": repeats, "n_repeat_words": total[words.first[1:]] - total[words.first[:-1]],
    }


def fertility_counts(path: str, data: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    """Tokens, byte-fallback tokens and token entropy (bits) of every row's words."""
    rows = len(words.first) - 1
    ids, size = tokens.word_pieces(path, data, words)
    owner = np.repeat(words.row, size)
    n = np.bincount(owner, minlength=rows)
    fallback = np.bincount(owner[(ids >= 3) & (ids < 259)], minlength=rows)
    seen, count = np.unique(owner * (1 << 17) + ids, return_counts=True)
    spread = np.bincount(seen >> 17, weights=count * np.log2(count), minlength=rows)
    entropy = np.log2(np.maximum(n, 1)) - spread / np.maximum(n, 1)
    return {"n_tokens": n, "n_byte_tokens": fallback, "entropy": entropy}


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens")
_SCHEMA = "doc_id long, language string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", entropy double"


def script(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The script that most lead bytes of letters belong to."""
    totals = []
    for low, high in _SCRIPTS.values():
        run = np.concatenate([[0], np.cumsum((data >= low) & (data <= high) & ((data >= 0xC2) | (data <= 0x7A)), dtype=np.int64)])
        totals.append(run[offsets[1:]] - run[offsets[:-1]])
    names = list(_SCRIPTS)
    return ["script:" + names[i] for i in np.argmax(np.stack(totals), axis=0)]


def measure(docs: DataFrame, vocabulary: str = tokens.PIECE_BPE) -> DataFrame:
    """One row of counts per row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokens.vocabulary(vocabulary)
        for batch in in_pieces(batches, 4 << 20):
            data, offsets = utf8(batch.column(1))
            words = Words(data, offsets, lower=False)
            found = {**base_counts(data, offsets, words), **fertility_counts(path, data, words)}
            language = batch.column(2)
            if language.null_count:
                language = pa.array([a or b for a, b in zip(language.to_pylist(), script(data, offsets), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), language, *[pa.array(found[c], pa.int64()) for c in _COUNTS], pa.array(found["entropy"], pa.float64())],
                ["doc_id", "language", *_COUNTS, "entropy"])

    # an empty language is none, whatever else its batch holds
    language = F.nullif(F.trim(F.col("lang").cast("string")), F.lit("")) if "lang" in docs.columns else F.lit(None).cast("string")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), language.alias("language"))
    return read.mapInArrow(run, _SCHEMA)


def with_measures(counts: DataFrame) -> DataFrame:
    """Add the three measures and base_failed. Without words the measures are null."""
    some = F.col("n_tokens") > 0
    # a text of n tokens cannot reach more than log2(n) bits
    ceiling = F.least(F.log2(F.col("n_tokens")), F.lit(9.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counts.withColumns({
        "chars_per_token": F.when(some, F.col("word_chars") / F.col("n_tokens")),
        "byte_share": F.when(some, F.col("n_byte_tokens") / F.col("n_tokens")),
        "entropy_ratio": F.when(F.col("n_tokens") > 1, F.col("entropy") / ceiling),
        "base_failed": failed,
        "size_class": F.floor(F.log2(F.greatest(F.col("n_words"), F.lit(1)))).cast("int"),
    })


def _bin(name: str) -> Column:
    low, high = MEASURES[name]
    return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col(name) - low) / ((high - low) / BINS)).cast("int")))


def bands(measured: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(language, size_class, and low and high of each measure) for every group with documents enough; size_class is null for
    a whole language, and both are null for all documents. One row per language and size: bounded by the languages."""
    passed = measured.where("NOT base_failed AND n_tokens > 1")
    named = F.array(*[F.struct(F.lit(m).alias("measure"), _bin(m).alias("bin")) for m in MEASURES])
    keys = ["language", "size_class", "measure", "bin"]
    counted = cut_lineage(passed.select("language", "size_class", F.explode(named).alias("m")).select(
        "language", "size_class", "m.measure", "m.bin").groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    none, no_class = F.lit(None).cast("string"), F.lit(None).cast("int")
    wider = counted.groupBy("language", "measure", "bin").agg(F.sum("n").alias("n")).withColumn("size_class", no_class).select(*keys, "n")
    whole = counted.groupBy("measure", "bin").agg(F.sum("n").alias("n")).withColumns({"language": none, "size_class": no_class}).select(*keys, "n")
    every = counted.unionByName(wider).unionByName(whole)
    key = W.partitionBy("language", "size_class", "measure")
    ranked = every.withColumns({"upto": F.sum("n").over(key.orderBy("bin")), "total": F.sum("n").over(key)})
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("total") * q, F.col("bin")))
    spots = ranked.groupBy("language", "size_class", "measure").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"), F.max("total").alias("total"))
    spots = spots.where((F.col("total") >= LEAST) | F.col("language").isNull())
    pick = lambda values: F.element_at(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(float(v)))]), F.col("measure"))
    bottom, step = pick({m: v[0] for m, v in MEASURES.items()}), pick({m: (v[1] - v[0]) / BINS for m, v in MEASURES.items()})
    value = lambda c: bottom + step * (F.col(c) + 0.5)
    down = F.greatest(pick(FLOOR), low * (value("q2") - value("q1")))
    up = F.greatest(pick(FLOOR), high * (value("q3") - value("q2")))
    limits = spots.select("language", "size_class", "measure", (value("q2") - down).alias("low"), (value("q2") + up).alias("high"))
    return limits.groupBy("language", "size_class").pivot("measure", list(MEASURES)).agg(F.first("low").alias("low"), F.first("high").alias("high"))


def judge(docs: DataFrame, vocabulary: str = tokens.PIECE_BPE, low: float = LOW, high: float = HIGH) -> DataFrame:
    """All counts and measures, base_failed and kept for every row: kept if the base rules hold and every measure lies in its band."""
    measured = cut_lineage(with_measures(measure(docs, vocabulary)))
    limits = cut_lineage(bands(measured, low, high))
    sides = [f"{m}_{side}" for m in MEASURES for side in ("low", "high")]
    whole = limits.where("language IS NULL").first()
    own = null_safe_join(measured, limits.where("size_class IS NOT NULL"), ["language", "size_class"], "left")
    wider = limits.where("language IS NOT NULL AND size_class IS NULL").select("language", *[F.col(c).alias(f"wide_{c}") for c in sides])
    own = null_safe_join(own, wider, ["language"], "left")
    band = {c: F.coalesce(F.col(c), F.col(f"wide_{c}"), F.lit(whole[c] if whole else None).cast("double")) for c in sides}
    inside = F.lit(True)
    for m in MEASURES:
        inside = inside & F.coalesce(F.col(m).between(band[f"{m}_low"], band[f"{m}_high"]), F.lit(False))
    return own.withColumn("kept", ~F.col("base_failed") & inside).select("doc_id", *_COUNTS[:5], "base_failed", "kept", "language", "n_tokens", *MEASURES)
