"""The numbered queries: thin callers of the operators over whole tables, and their SQL answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from glyphatlas.llm import (
    conversations,
    decontaminate,
    discriminant,
    exact_dedup,
    fertility,
    length_histogram,
    mixing,
    near_dup,
    repeats,
    sharding,
    token_alignment,
    token_codes,
    toxicity,
)
from glyphatlas.llm.answers import ANSWERS
from glyphatlas.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

__all__ = ["ANSWERS", "QUERIES"]


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup(table(spark, sf_dir, "documents")).drop("kept_bytes")


@query
def op2_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents"))


@query
def op3_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.components(table(spark, sf_dir, "documents"), 3, 85)


@query
def op4_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discriminant.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"))


@query
def op7_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


@query
def op8_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = length_histogram.encoded_lengths(table(spark, sf_dir, "documents"))
    return length_histogram.suffix_sums(length_histogram.length_histogram(lengths))


@query
def op9_levenshtein_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_codes.scratch(spark, "token-codes")
    token_codes.write_codes(table(spark, sf_dir, "documents"), path)
    return token_codes.read_codes(spark, path)


@query
def op11_path_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damage_and_repair(table(spark, sf_dir, "conversations"))


@query
def op12_end_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.scored(table(spark, sf_dir, "documents"))


@query
def op13_salted_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))
