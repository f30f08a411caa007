"""Exact duplicates by skew-safe combining, in DataFrame functions only.

1. Deduplicate locally: every map task folds its rows of equal text into one (the partial aggregate, keyed by the text itself).
2. Merge salted groups: the local winners of a text meet in one of `SALTS` groups by (digest, salt, text), so a text that a third of all rows
   share is spread over as many tasks.
3. Combine globally: the at most `SALTS` salt winners of a text meet by (digest, text).

Every stage groups by the full normalised text next to its digest, so texts that only share a digest are never mixed. The same pass
counts the texts of each digest: where there is a single one, rows find their class by digest alone, because all texts with that digest
have been compared; where a digest stands for several texts, rows find their class by the whole text.

Defined results: a null text is the empty text; texts are equal when identical after lower-casing A-Z only; of equal texts the largest doc_id
stays, and null is smaller than any; rows that repeat both doc_id and text are one document and are marked alike (`kept_rows`
returns one of them). Further columns are left alone. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphatlas.llm.common import doc_texts, join_with_hot_keys
from glyphatlas.session import cut_lineage

SALTS = 16
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """`text` with A-Z lowered and nothing else."""
    return F.translate(text, CAPITALS, SMALL)


def _texts(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    rows = doc_texts(docs).select("doc_id", normalised(F.col("text")).alias("text"))
    return rows.withColumn("digest", digest(F.col("text")))


def winners(rows: DataFrame) -> DataFrame:
    """(digest, text, keep_id, group_size): one row for each distinct text of (doc_id, text, digest)."""
    # a task has one salt, so that it sends a single row for each of its texts
    salted = rows.withColumn("salt", F.spark_partition_id() % SALTS)
    merged = salted.groupBy("digest", "salt", "text").agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))
    # dealt by digest, so that the texts of a digest can be counted where they lie
    dealt = merged.repartition("digest")
    return dealt.groupBy("digest", "text").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))


def duplicates(docs: DataFrame, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of `docs`."""
    facts = cut_lineage(_texts(docs, digest).select("doc_id", "digest", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")))
    per_digest = winners(_texts(docs, digest)).groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    classes = cut_lineage(per_digest)
    alone = classes.where("texts = 1").drop("texts")
    shared = classes.where("texts > 1").select("digest", "group_size")
    found = join_with_hot_keys(facts, alone, ["digest"], "group_size")
    if not shared.isEmpty():
        # few digests stand for several texts: their rows are compared by the texts themselves
        rows = cut_lineage(join_with_hot_keys(_texts(docs, digest), shared, ["digest"], "group_size").drop("group_size"))
        classed = cut_lineage(winners(rows))
        again = join_with_hot_keys(rows, classed, ["digest", "text"], "group_size")
        found = found.unionByName(again.withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256)).drop("text"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; of rows that repeat doc_id and text, one."""
    stay = duplicates(docs).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    sha = F.sha2(normalised(F.coalesce("text", F.lit(""))).cast("binary"), 256)
    marked = docs.withColumn("__own", sha)
    joined = marked.join(stay, marked["doc_id"].cast("long").eqNullSafe(stay["__id"]) & (marked["__own"] == stay["__sha"]), "left_semi")
    return joined.dropDuplicates(["doc_id", "__own"]).drop("__own")
