"""Tagged texts to lines and typed records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphatlas.functions import records as R
from glyphatlas.operators.ranking import exact_quantiles
from glyphatlas.vocab import MAX_VALUES_SHOWN, VALUE_FIELDS


def tagged_lines(texts: DataFrame, key: str = "path") -> DataFrame:
    """(key, line_no, field, content): one row per well-formed line, numbered from 0 within its text."""
    return texts.select(key, F.posexplode(R.tagged_lines(F.col("text"))).alias("line_no", "x")).select(
        key, F.col("line_no").cast("bigint").alias("line_no"), "x.field", "x.content"
    )


def tagged_records(texts: DataFrame, max_values: int = MAX_VALUES_SHOWN) -> DataFrame:
    """One typed row per tagged text. Input (path, text, ...): further columns such as mtime pass through.

    Two projections, so that the line array and the header are computed once and then read by all fields.
    """
    passing = [c for c in texts.columns if c not in ("path", "text")]
    lines = texts.select("path", *passing, R.tagged_lines(F.col("text")).alias("lines"))
    staged = lines.select(
        "path",
        *passing,
        "lines",
        R.parse_header(F.col("lines")).alias("header"),
        R.value_terms(R.field_contents(F.col("lines"), *VALUE_FIELDS)).alias("terms"),
    )
    ln, terms, header = F.col("lines"), F.col("terms"), F.col("header")
    joined = lambda code: F.array_join(R.field_contents(ln, code), "\n")
    keyword_lines = F.transform(R.field_contents(ln, "K"), R.keyword_list)
    keywords = F.get(F.filter(keyword_lines, lambda k: F.size(k) > 0), F.lit(0))
    return staged.select(
        F.coalesce(header["id"], F.upper(R.file_stem(F.col("path")))).alias("id"),
        R.first_non_empty(R.field_contents(ln, "N")).alias("name"),
        joined("C").alias("comments"),
        joined("F").alias("formulas"),
        joined("e").alias("examples"),
        F.coalesce(keywords, F.array().cast("array<string>")).alias("keywords"),
        R.first_non_empty(R.field_contents(ln, "O")).alias("offset"),
        R.int64_prefix(terms, max_values).alias("values"),
        R.values_preview(terms, max_values).alias("values_preview_str"),
        F.size(terms).cast("bigint").alias("n_terms_visible"),
        R.first_non_empty(R.field_contents(ln, "A")).alias("author"),
        F.coalesce(header["edits"], F.lit(0).cast("bigint")).alias("edit_count"),
        header["stamp"].alias("last_edited"),
        R.count_field(ln, "D").alias("n_references"),
        R.count_field(ln, "H").alias("n_links"),
        R.count_field(ln, "E").alias("n_extensions"),
        R.code_languages(ln).alias("code_languages"),
        R.has_bfile(ln).alias("has_bfile"),
        *passing,
        F.col("path").alias("path_rel"),
    )


def parse_report(records: DataFrame) -> DataFrame:
    """One row: rows, median and maximum edit count, rows with code, rows with keywords."""
    return records.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(exact_quantiles(records, "edit_count", {"m": 0.5}).scalar()).alias("median_edits"),
        F.max("edit_count").alias("max_edits"),
        F.count_if(F.size("code_languages") > 0).alias("with_code"),
        F.count_if(F.size("keywords") > 0).alias("with_keywords"),
    )
