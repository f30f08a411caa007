"""Vector tables (id, embedding): normalising, lookups, class sums, cohesion and invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphatlas.functions.vectors import dimension, dot, doubles, norm, sum_vectors, unit


def l2_normalize(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("embedding", unit(doubles(F.col("embedding"))))


def norm_stats(vectors: DataFrame) -> DataFrame:
    """One row: mean, smallest and largest vector length."""
    lengths = vectors.select(norm(doubles(F.col("embedding"))).alias("n"))
    return lengths.agg(F.avg("n").alias("mean_norm"), F.min("n").alias("min_norm"), F.max("n").alias("max_norm"))


def vector_invariants(vectors: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """One row of violation counts: missing or NaN elements, length not 1, and the number of dimensions seen."""
    v = doubles(F.col("embedding"))
    return vectors.agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.count_if(F.exists(v, lambda x: x.isNull() | F.isnan(x))).alias("n_nan"),
        F.count_if(F.abs(norm(v) - 1) > tolerance).alias("n_not_unit"),
        F.count_distinct(F.size(v)).alias("n_dims"),
    )


def pair_cosines(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """(src, dst, cosine) for given pairs of ids: two lookups, never all pairs."""
    v = vectors.select("id", doubles(F.col("embedding")).alias("v"))
    left = v.select(F.col("id").alias("src"), F.col("v").alias("a"))
    right = v.select(F.col("id").alias("dst"), F.col("v").alias("b"))
    return pairs.join(left, "src").join(right, "dst").select("src", "dst", dot(F.col("a"), F.col("b")).alias("cosine"))


def class_members(df: DataFrame, col: str, allowed: tuple[str, ...] | None = None, min_size: int = 2) -> DataFrame:
    """(id, class) of the classes with at least `min_size` members; a repeated class counts once per row."""
    rows = df.select("id", F.explode(F.array_distinct(col)).alias("class")).where(F.col("class").isNotNull())
    if allowed is not None:
        rows = rows.where(F.col("class").isin(*allowed))
    large = rows.groupBy("class").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_size).select("class")
    return rows.join(large, "class", "left_semi").select("id", "class")


def class_sums(vectors: DataFrame, members: DataFrame, by: tuple[str, ...] = (), dim: int | None = None) -> DataFrame:
    """(by..., class, n, total): number of members and sum vector per class."""
    d = dim or dimension(vectors)
    v = vectors.select(*by, "id", doubles(F.col("embedding")).alias("v"))
    return sum_vectors(members.join(v, "id"), [*by, "class"], "v", d)


def class_centroids(vectors: DataFrame, members: DataFrame, dim: int | None = None) -> DataFrame:
    sums = class_sums(vectors, members, (), dim)
    return sums.select("class", "n", F.transform("total", lambda x: x / F.col("n")).alias("centroid"))


def class_cohesion(vectors: DataFrame, members: DataFrame, by: tuple[str, ...] = (), dim: int | None = None) -> DataFrame:
    """(by..., class, n, intra, inter, gap) for unit vectors, from class sums alone.

    With s the class sum and t the sum of all vectors, the mean cosine over distinct member pairs is
    (s.s - n) / (n (n-1)) and the mean over member/non-member pairs is s.(t - s) / (n (N - n)): linear in
    the rows, whatever the class sizes. Classes with fewer than two members, or all rows, are left out.
    """
    d = dim or dimension(vectors)
    rows = vectors.select(*by, doubles(F.col("embedding")).alias("v"))
    everything = sum_vectors(rows, list(by), "v", d).select(*by, F.col("n").alias("all_n"), F.col("total").alias("all_total"))
    sums = class_sums(vectors, members, by, d)
    if by:
        joined = sums.join(everything, list(by))
    else:
        one = everything.select(F.struct("all_n", "all_total").alias("o")).scalar()
        joined = sums.withColumn("_o", one).select("*", "_o.all_n", "_o.all_total").drop("_o")
    s, n, total = F.col("total"), F.col("n"), F.col("all_n")
    intra = (dot(s, s) - n) / (n * (n - 1))
    inter = dot(s, F.zip_with("all_total", s, lambda x, y: x - y)) / (n * (total - n))
    kept = joined.where((n >= 2) & (n < total)).select(*by, "class", "n", intra.alias("intra"), inter.alias("inter"))
    return kept.withColumn("gap", F.col("intra") - F.col("inter"))


def cohesion_summary(cohesion: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Plain and size-weighted means over classes; 0 where no class could be scored."""
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    weighted = F.coalesce(F.sum(F.col("n") * F.col("gap")) / F.sum("n"), F.lit(0.0))
    return cohesion.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_classes"),
        mean("intra").alias("mean_intra"),
        mean("inter").alias("mean_inter"),
        mean("gap").alias("mean_gap"),
        weighted.alias("weighted_gap"),
    )
