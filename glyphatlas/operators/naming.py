"""Exemplars, keyphrases, names and reports of clusters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphatlas.functions.strings import head, strip
from glyphatlas.functions.vectors import dimension, doubles, sum_vectors
from glyphatlas.vocab import EXEMPLAR_CHARS, NOISE, UNLABELLED, UNNAMED_TOPIC

MIN_TERM_CHARS = 3


def exemplars(layers: DataFrame, vectors: DataFrame, n: int = 3, dim: int | None = None) -> DataFrame:
    """(layer, cluster_id, rank, id, distance): the members nearest to their cluster's mean vector.

    The rank filter lets Spark keep only n rows per cluster before the shuffle, so a cluster holding a
    third of all rows is not sorted in one task.
    """
    d = dim or dimension(vectors)
    v = vectors.select("id", doubles(F.col("embedding")).alias("v"))
    rows = layers.where(F.col("cluster_id") != NOISE).join(v, "id")
    sums = sum_vectors(rows, ["layer", "cluster_id"], "v", d)
    means = sums.select("layer", "cluster_id", F.transform("total", lambda x: x / F.col("n")).alias("mean"))
    gap = F.aggregate(F.zip_with("v", "mean", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    far = rows.join(means, ["layer", "cluster_id"]).select(
        "layer", "cluster_id", "id", F.round(F.sqrt(gap), 9).alias("distance"))
    order = W.partitionBy("layer", "cluster_id").orderBy("distance", "id")
    return far.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= n)


def terms(text: Column) -> Column:
    """Lower-case words of letters, at least MIN_TERM_CHARS long, of the whole text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda t: F.length(t) >= MIN_TERM_CHARS)


def keyphrases(docs: DataFrame, k: int = 8, by: tuple[str, ...] = ("cluster_id",)) -> DataFrame:
    """(by..., rank, term, score) of the k most telling terms per cluster of (by..., text) rows.

    Score: share of the term in the cluster times ln(1 + mean cluster length / uses of the term overall).
    Terms are counted per cluster before anything is joined.
    """
    counts = docs.select(*by, F.explode(terms(F.col("text"))).alias("term")).groupBy(*by, "term").agg(
        F.count(F.lit(1)).alias("n"))
    length = counts.groupBy(*by).agg(F.sum("n").alias("length"))
    uses = counts.groupBy("term").agg(F.sum("n").alias("uses"))
    mean = length.agg(F.avg("length")).scalar()
    scored = counts.join(length, list(by)).join(uses, "term").select(
        *by, "term", F.round(F.col("n") / F.col("length") * F.log1p(mean / F.col("uses")), 9).alias("score"))
    order = W.partitionBy(*by).orderBy(F.col("score").desc(), "term")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.where(F.col("rank") <= k).select(*by, "rank", "term", "score")


def name_clusters(
    phrases: DataFrame, by: tuple[str, ...] = ("cluster_id",), namer: Callable[[list[dict]], list[str]] | None = None,
    n_terms: int = 3,
) -> DataFrame:
    """(by..., name). The default name joins the best terms; equal names get one more term, then their key.

    A `namer` gets batches of {by..., terms} and returns one name each; blank names become a placeholder.
    """
    lists = phrases.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("t"))  # k rows
    lists = lists.select(*by, F.transform("t", lambda x: x["term"]).alias("terms"))
    if namer is not None:
        schema = lists.select(*by, F.lit("").alias("name")).schema

        def call(frames):
            for f in frames:
                rows = f.to_dict("records")
                names = namer([{**r, "terms": list(r["terms"])} for r in rows])
                yield f[list(by)].assign(name=[n if isinstance(n, str) else None for n in names])

        named = lists.mapInPandas(call, schema)
        return named.select(*by, name_or_placeholder(F.col("name")).alias("name"))
    join = lambda m: F.array_join(F.slice("terms", 1, m), ", ")
    tried = lists.select(*by, join(n_terms).alias("short"), join(n_terms + 1).alias("long"))
    layer = [c for c in by if c != "cluster_id"]
    shorts = tried.groupBy(*layer, "short").agg(F.count(F.lit(1)).alias("n_short"))
    longs = tried.groupBy(*layer, "long").agg(F.count(F.lit(1)).alias("n_long"))
    counted = tried.join(shorts, [*layer, "short"]).join(longs, [*layer, "long"])
    last = F.concat("long", F.lit(" #"), F.col(by[-1]).cast("string"))
    name = F.when(F.col("n_short") == 1, F.col("short")).when(F.col("n_long") == 1, F.col("long")).otherwise(last)
    return counted.select(*by, name_or_placeholder(name).alias("name"))


def name_or_placeholder(name: Column) -> Column:
    clean = strip(F.coalesce(name, F.lit("")))
    return F.when(clean == "", F.lit(UNNAMED_TOPIC)).otherwise(clean)


def label_points(layers: DataFrame, names: DataFrame) -> DataFrame:
    """(id, layer, cluster_id, label); noise is labelled as such."""
    named = layers.join(names.withColumnRenamed("name", "label"), ["layer", "cluster_id"], "left")
    return named.select("id", "layer", "cluster_id", F.coalesce("label", F.lit(UNLABELLED)).alias("label"))


def label_pivot(labels: DataFrame, n_layers: int) -> DataFrame:
    """One row per id with label_layer_0..n-1; the layer numbers are given, so no extra job looks for them."""
    cols = [F.max(F.when(F.col("layer") == i, F.col("label"))).alias(f"label_layer_{i}") for i in range(n_layers)]
    return labels.groupBy("id").agg(*cols)


def label_summary(labels: DataFrame) -> DataFrame:
    """Per layer: rows, distinct labels, unlabelled rows and their share; labels are counted first."""
    counts = labels.groupBy("layer", "label").agg(F.count(F.lit(1)).alias("n"))
    bare = F.coalesce(F.sum(F.when(F.col("label") == UNLABELLED, F.col("n"))), F.lit(0))
    return counts.groupBy("layer").agg(
        F.sum("n").alias("n_rows"),
        F.count("label").alias("n_labels"),
        bare.alias("n_unlabelled"),
        F.round(100.0 * bare / F.sum("n"), 1).alias("pct_unlabelled"),
    )


def top_labels(labels: DataFrame, n: int = 10) -> DataFrame:
    """(layer, rank, label, n): the largest labels of every layer."""
    counts = labels.groupBy("layer", "label").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy("layer").orderBy(F.col("n").desc(), "label")
    return counts.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= n)


def shorten(text: Column, limit: int = EXEMPLAR_CHARS) -> Column:
    flat = F.replace(strip(text), F.lit("\n"), F.lit(" "))
    return F.when(F.length(flat) <= limit, flat).otherwise(F.concat(head(flat, limit - 3), F.lit("...")))


def layer_report(layers: DataFrame, names: DataFrame, picks: DataFrame, texts: DataFrame) -> DataFrame:
    """(layer, cluster_id, name, n_members, n_noise, exemplars): clusters with their size, the noise of the
    layer and up to three shortened exemplar texts."""
    sizes = layers.groupBy("layer", "cluster_id").agg(F.count(F.lit(1)).alias("n_members"))
    noise = sizes.where(F.col("cluster_id") == NOISE).select("layer", F.col("n_members").alias("n_noise"))
    quoted = picks.join(texts.select("id", shorten(F.col("text")).alias("text")), "id").groupBy("layer", "cluster_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("e"))  # a few rows per cluster
    out = sizes.where(F.col("cluster_id") != NOISE).join(names, ["layer", "cluster_id"], "left").join(
        quoted, ["layer", "cluster_id"], "left").join(noise, "layer", "left")
    return out.select(
        "layer", "cluster_id", name_or_placeholder(F.col("name")).alias("name"), "n_members",
        F.coalesce("n_noise", F.lit(0)).alias("n_noise"), F.transform("e", lambda x: x["text"]).alias("exemplars"))
