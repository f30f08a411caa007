"""Exact length histogram: documents by encoded length, and what suffix sums over it answer.

Every whole text is encoded once; only (length, number of documents) is shuffled, summed before the shuffle, so a
length that a third of all documents share costs no more than another. Totals over longer and shorter
documents are running sums over the distinct lengths, which are dealt out in ranges.

Null or empty texts have length 0; an empty table gives an empty histogram; repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphatlas.llm import tokens
from glyphatlas.llm.common import doc_texts, in_pieces, utf8
from glyphatlas.operators.ranking import running_totals
from glyphatlas.session import cut_lineage


def encoded_lengths(docs: DataFrame, vocabulary: str = tokens.BYTE_BPE) -> DataFrame:
    """(doc_id, n_tokens) of every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokens.vocabulary(vocabulary)
        for batch in in_pieces(batches):
            n = tokens.byte_bpe_lengths(path, *utf8(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return doc_texts(docs).mapInArrow(measure, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(length, n_docs) from a column n_tokens."""
    return lengths.groupBy(F.col("n_tokens").alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per distinct length L, as a context limit:

    docs_longer, tokens_longer: documents with more than L tokens, and their tokens; docs_upto, tokens_upto: the
    others; truncated_total: tokens that are left when every document is cut to L; lost_total: tokens that are cut
    off; quantile: share of documents with at most L tokens; total_docs and total_tokens over all.
    """
    histogram = cut_lineage(histogram)
    tokens_here = F.col("length") * F.col("n_docs")
    above = running_totals(histogram, [F.col("length").desc()], {"docs_longer": F.col("n_docs"), "tokens_longer": tokens_here})
    n_docs, n_tokens = histogram.agg(F.sum("n_docs"), F.sum(tokens_here)).first()
    out = above.withColumns({"total_docs": F.lit(n_docs).cast("long"), "total_tokens": F.lit(n_tokens).cast("long")})
    upto = F.col("total_tokens") - F.col("tokens_longer")
    kept = upto + F.col("length") * F.col("docs_longer")
    return out.select(
        "length", "n_docs", "docs_longer", "tokens_longer",
        (F.col("total_docs") - F.col("docs_longer")).alias("docs_upto"), upto.alias("tokens_upto"),
        kept.alias("truncated_total"), (F.col("total_tokens") - kept).alias("lost_total"),
        ((F.col("total_docs") - F.col("docs_longer")) / F.col("total_docs")).alias("quantile"),
        "total_docs", "total_tokens",
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_upto, docs_longer, truncated_total) for any given limits, whether or not a document has
    that length."""
    wanted = sorted({int(x) for x in limits})
    each = histogram.withColumn("context_limit", F.explode(F.array(*[F.lit(x).cast("long") for x in wanted])))
    fits = F.col("length") <= F.col("context_limit")
    return each.groupBy("context_limit").agg(
        F.sum(F.when(fits, F.col("n_docs")).otherwise(0)).alias("docs_upto"),
        F.sum(F.when(fits, 0).otherwise(F.col("n_docs"))).alias("docs_longer"),
        F.sum(F.least("length", "context_limit") * F.col("n_docs")).alias("truncated_total"))


def length_at_quantile(curve: DataFrame, q: float) -> DataFrame:
    """(length): the smallest length that at least the share `q` of the documents does not exceed."""
    return curve.where(F.col("quantile") >= q).agg(F.min("length").alias("length"))
