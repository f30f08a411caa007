"""Tables behind a map: display points, palettes, facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphatlas.functions import display as D
from glyphatlas.functions.compose import search_text
from glyphatlas.operators.ranking import grouped_quantiles, with_position
from glyphatlas.vocab import (
    AUTHOR_TOP_N,
    DEFAULT_MIN_YEAR,
    ENUM_FIELDS,
    MARKER_RANGE,
    OTHER_LABEL,
    UNKNOWN_LABEL,
)

RANGE_FIELDS = ("edits", "refs", "links")
# Enum field -> name of its filter column.
ENUM_FILTERS = dict(zip(ENUM_FIELDS, ("domain_filter", "type_filter", "growth_filter", "era_filter"), strict=True))


def topn_bucket(df: DataFrame, col: str, out: str, n: int = AUTHOR_TOP_N, other: str = OTHER_LABEL) -> DataFrame:
    """Keep the n most frequent non-empty values of `col` (ties by name); all others become `other`."""
    counts = df.where(F.col(col) != "").groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.col("_n").desc(), col).limit(n).select(col, F.col(col).alias("_kept"))
    joined = df.join(F.broadcast(top), col, "left")  # n rows
    return joined.select(*df.columns, F.coalesce("_kept", F.lit(other)).alias(out))


def marker_size(df: DataFrame, col: str, out: str = "marker_size", span=MARKER_RANGE) -> DataFrame:
    """sqrt(max(value, 1)) stretched to `span`; the middle of it if all values are equal."""
    low, high = span
    root = F.sqrt(F.greatest(F.coalesce(F.col(col), F.lit(1)), F.lit(1)).cast("double"))
    ends = df.agg(F.struct(F.min(root).alias("lo"), F.max(root).alias("hi")).alias("e")).scalar()
    width = ends["hi"] - ends["lo"]
    size = low + (high - low) * (root - ends["lo"]) / width
    return df.withColumn(out, F.when(width < 1e-9, F.lit((low + high) / 2)).otherwise(size))


def category_palette(df: DataFrame, col: str) -> DataFrame:
    """(value, position, hue): distinct values in order, nulls and blanks as unknown; hues by golden angle."""
    named = F.when((F.col(col) == "") | F.col(col).isNull(), UNKNOWN_LABEL).otherwise(F.col(col))
    placed = with_position(df.select(named.alias("value")).distinct(), [F.col("value")])
    return placed.select("value", "position", F.round((F.col("position") * 137.508) % 360, 3).alias("hue"))


def map_points(records: DataFrame, coords: DataFrame, labels_wide: DataFrame) -> DataFrame:
    """One row per record: position, labels, escaped display strings, plain filter columns and channels.

    Works with or without the enum columns. Positions and labels are joined by id.
    """
    has_enums = all(f in records.columns for f in ENUM_FIELDS)
    base = records.withColumn("_author", D.clean_author(F.col("author")))
    base = marker_size(topn_bucket(base, "_author", "author_filter"), "edit_count")
    label_cols = [c for c in labels_wide.columns if c.startswith("label_layer_")]
    joined = base.join(coords.select("id", "x", "y"), "id")
    joined = align_labels(joined, labels_wide.select("id", *label_cols))
    whole = lambda c: D.int_or_zero(F.col(c))
    cols: dict[str, Column] = {
        "x": F.col("x"),
        "y": F.col("y"),
        **{c: F.col(c) for c in label_cols},
        "name": D.html_escape(F.col("name")),
        "first_formula": D.html_escape(D.first_line(F.col("formulas"))),
        "values_preview_str": D.html_escape(F.col("values_preview_str")),
        "edit_count": whole("edit_count"),
        "n_references": whole("n_references"),
        "author": D.html_escape(F.col("_author")),
        "keywords": D.html_escape(D.join_keywords(F.col("keywords"))),
        "search_text": search_text(None),
        "author_filter": F.col("author_filter"),
        "keywords_filter": D.join_keywords(F.col("keywords"), "|"),
        "edits_filter": whole("edit_count"),
        "refs_filter": whole("n_references"),
        "links_filter": whole("n_links"),
        "year_filter": D.year_or_zero(F.col("last_edited")),
        "marker_size": F.col("marker_size"),
        "log_edits": D.log_edits(F.col("edit_count")),
        "log_refs": D.log_references(F.col("n_references")),
    }
    if has_enums:
        for f, name in ENUM_FILTERS.items():
            cols[f] = D.html_escape(D.label_or_unknown(F.col(f)))
            cols[name] = D.label_or_unknown(F.col(f))
    return joined.select(D.html_escape(F.col("id")).alias("id"), *[c.alias(n) for n, c in cols.items()])


def facet_values(points: DataFrame, fields: dict[str, str]) -> DataFrame:
    """(facet, value, position): distinct values per facet, alphabetic, with the tail labels pinned last."""
    pairs = ", ".join(f"'{name}', cast(`{col}` as string)" for name, col in fields.items())
    values = points.select(F.expr(f"stack({len(fields)}, {pairs}) AS (facet, value)")).where("value is not null").distinct()
    order = [F.col("facet"), D.tail_rank(F.col("value")), F.col("value")]
    placed = with_position(values, order, "_p")
    first = placed.groupBy("facet").agg(F.min("_p").alias("_s"))
    return placed.join(first, "facet").select("facet", "value", (F.col("_p") - F.col("_s")).alias("position"))


def keyword_universe(records: DataFrame) -> DataFrame:
    return records.select(F.explode("keywords").alias("keyword")).where("keyword <> ''").distinct()


def facet_ranges(points: DataFrame) -> DataFrame:
    """(facet, min, max, slider_max): counts capped at the truncated 99th percentile; years ignore 0 below."""
    pairs = ", ".join(f"'{f}', {f}_filter" for f in RANGE_FIELDS)
    rows = points.select(F.expr(f"stack({len(RANGE_FIELDS)}, {pairs}) AS (facet, v)"))
    ends = rows.groupBy("facet").agg(F.min("v").alias("min"), F.max("v").alias("max"))
    caps = grouped_quantiles(rows, ["facet"], "v", {"p99": 0.99})
    counts = ends.join(caps, "facet").select("facet", "min", "max", F.floor("p99").alias("slider_max"))
    year = F.col("year_filter")
    top = F.max(year)
    low = F.coalesce(F.min(F.when(year > 0, year)), F.lit(DEFAULT_MIN_YEAR).cast("bigint"))
    years = points.agg(low.alias("min"), top.alias("max"), top.alias("slider_max")).select(
        F.lit("year").alias("facet"), "min", "max", "slider_max")
    return counts.unionByName(years)


def facet_table(points: DataFrame, records: DataFrame) -> DataFrame:
    """(facet, position, value, min, max, slider_max): the values of every facet in their order, the keywords, and the ends of every range; a row each,
    so that no vocabulary meets in one row."""
    fields = _facet_fields(points)
    none = F.lit(None).cast("bigint")
    values = facet_values(points, fields).select("facet", F.col("position").cast("bigint").alias("position"), "value")
    words = with_position(keyword_universe(records), [F.col("keyword")], "position").select(F.lit("keywords").alias("facet"), "position", F.col("keyword").alias("value"))
    listed = values.unionByName(words).withColumns({"min": none, "max": none, "slider_max": none})
    ranges = facet_ranges(points).select(
        "facet", none.alias("position"), F.lit(None).cast("string").alias("value"), *[F.col(c).cast("bigint").alias(c) for c in ("min", "max", "slider_max")])
    return listed.unionByName(ranges)


def _facet_fields(points: DataFrame) -> dict[str, str]:
    fields = {"authors": "author_filter"}
    if "domain_filter" in points.columns:
        fields.update({"domains": "domain_filter", "types": "type_filter", "growths": "growth_filter", "eras": "era_filter"})
    return fields


def align_labels(points: DataFrame, labels: DataFrame) -> DataFrame:
    """Every point once, with the columns of its row of `labels`; null where it has none."""
    return points.join(labels, "id", "left")


def facets(points: DataFrame, records: DataFrame) -> DataFrame:
    """The whole facet configuration as one row with one JSON document, for a map whose vocabularies fit a page; `facet_table` has them as rows."""
    values = facet_values(points, _facet_fields(points)).groupBy("facet").agg(
        F.array_sort(F.collect_list(F.struct("position", "value"))).alias("v"))
    lists = values.agg(F.map_from_entries(F.collect_list(F.struct("facet", F.transform("v", lambda x: x["value"]))))).scalar()
    words = keyword_universe(records).agg(F.array_sort(F.collect_list("keyword"))).scalar()
    spans = facet_ranges(points).agg(F.map_from_entries(F.collect_list(F.struct(
        "facet", F.struct("min", "max", F.col("slider_max").alias("sliderMax")))))).scalar()
    empty = F.array().cast("array<string>")
    return points.agg(F.count(F.lit(1)).alias("totalCount")).select(F.to_json(F.struct(
        "totalCount",
        *[F.coalesce(F.try_element_at(lists, F.lit(k)), empty).alias(k) for k in ("authors", "domains", "types", "growths", "eras")],
        words.alias("keywords"),
        spans.alias("ranges"),
    )).alias("config"))
