"""Small tables that hold every awkward case at once."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

# Further columns whose names operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, key long, copy int, h long, place long, label int, row long, slot long, "
    "rank long, words string, item_id long, n_words long, score double, shard int, rep long, sig string"
)
EXTRA = (1, 2, 3, 4, 5, 6, 7, 8, 9, "x", 10, 11, 0.5, 12, 13, "y")


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    parts = "an re the ion est ter ing or al en ou qu ti ma lo sa ve".split()
    words = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("." if draw.random() < 0.1 else "") for w in words)


def messy_rows() -> list[tuple]:
    base = prose(1, 120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "fr", "b"), (4, prose(2, 90), "de", None), (5, "", "en", "a"), (6, None, None, None),
        (7, "   \n\t ", "en", "b"), (8, "one two", "en", "c"), (9, "One  TWO\n", "en", "c"), (10, "x", None, "é"), (None, base, "en", "a"), (None, None, None, None),
        (11, prose(3, 80) + "\n" + base, "en", "b"), (12, "ab" * 400, "en", "c"), (13, "é" * 150 + " " + "ü ö" * 40, "fr", "c"), (14, prose(4, 6000), "en", "a"),
        (15, "a\x00b " * 60, "en", "b"), (16, base, "en", "b"), (16, base, "en", "b"), (17, prose(5, 70), "es", "b"), (17, prose(6, 70), "es", "b"),
        (18, "line of words that comes again\n" * 30, "en", "a"), (19, "### $$$ *** " * 40, "en", "a"), (20, prose(7, 100) + " <|endoftext|> it's 12.5", "en", "c"),
    ]
    return [(*r, len(r[1] or ""), *EXTRA) for r in rows]


def messy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(messy_rows(), SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def texts(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
