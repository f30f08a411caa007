"""Vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphatlas.functions.strings import let


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def unit(v: Column) -> Column:
    """`v` scaled to length 1; a zero vector stays as it is."""
    # the length is handed over as an array element, so that it is worked out once per row and not per element
    return let(norm(v), lambda n: F.transform(v, lambda x: x / F.when(n == 0, F.lit(1.0)).otherwise(n)))


def dimension(vectors: DataFrame, col: str = "embedding") -> int:
    """Length of the vectors, read from one row."""
    row = vectors.select(F.size(col).alias("d")).first()
    if row is None:
        raise ValueError("no vectors")
    return row["d"]


CHUNK = 16


def chunks(v: Column, dim: int) -> Column:
    """array<struct<chunk, part>>: the vector in pieces of CHUNK elements. Sums over pieces compile to small
    code whatever the dimension."""
    return F.transform(F.sequence(F.lit(0), F.lit((dim - 1) // CHUNK)), lambda c: F.struct(
        c.alias("chunk"), F.slice(v, c * CHUNK + 1, CHUNK).alias("part")))


def sum_part(part: Column, weight: Column | None = None) -> Column:
    """Element-wise (weighted) sum of pieces: plain sums, added up before the shuffle, so that a hot key
    costs no more than a cold one. A short last piece leaves nulls at its end."""
    at = [F.get(part, F.lit(i)) for i in range(CHUNK)]
    return F.array(*[F.sum(x if weight is None else x * weight) for x in at])


def join_parts(dim: int) -> Column:
    """Aggregate: the vector of the (chunk, part) rows of a group, one row per piece."""
    parts = F.array_sort(F.collect_list(F.struct("chunk", "part")))
    return F.slice(F.flatten(F.transform(parts, lambda p: p["part"])), 1, dim)


def sum_vectors(rows: DataFrame, keys: list[str], col: str, dim: int) -> DataFrame:
    """(keys..., n, total): number and sum of the vectors in `col` per key."""
    pieces = rows.select(*keys, F.inline(chunks(F.col(col), dim)))
    sums = pieces.groupBy(*keys, "chunk").agg(F.count(F.lit(1)).alias("n"), sum_part(F.col("part")).alias("part"))
    return sums.groupBy(*keys).agg(F.max("n").alias("n"), join_parts(dim).alias("total"))


def round_vector(v: Column, digits: int) -> Column:
    return F.transform(v, lambda x: F.round(x, digits) + F.lit(0.0))


def vector_string(v: Column, digits: int) -> Column:
    """Rounded elements as fixed-point text, joined by commas."""
    return F.array_join(F.transform(round_vector(v, digits), lambda x: F.format_string(f"%.{digits}f", x)), ",")
