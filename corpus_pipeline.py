"""A corpus pipeline over `documents`: toxicity, near-duplicates, decontamination, mixing and sharding.

STAGES names five functions of (spark, docs, sf_dir), each one operator of glyphatlas.llm. `run` writes what a stage keeps as Parquet
into the shared folder and reads it again for the next one, so a lost executor costs no more than a stage's tasks. All stages but the
last return the columns of `documents`.

Defined results: null and empty texts, and rows without doc_id, are judged by their own text alone: a rejected row takes no other row
with it, whatever ids they share. The near-duplicate stage keeps one row of each doc_id, and all rows without one. The mixing stage deals out words,
so rows without words go there. Extra columns are carried along; an empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphatlas.llm import decontaminate, mixing, near_dup, sharding, toxicity
from glyphatlas.llm.common import drop_marked, table
from glyphatlas.llm.token_codes import scratch

SHINGLE, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject."""
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return drop_marked(docs, scored.where("predicted = 1"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8."""
    return near_dup.first_of_each(docs, SHINGLE, PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once for every reading of its source's stream in which the mix takes its first word."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row, with the text."""
    return sharding.place_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Tokens of edit distance, sketches and tilings have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        place = scratch(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.withColumns({c: F.col(c).cast("string") for c, kind in out.dtypes if kind == "void"}).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
