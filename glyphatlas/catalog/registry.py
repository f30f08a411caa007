"""Named queries: a Spark callable and, where SQL can express it, an independent answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ANSWERS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ANSWERS[name] = sql
        return run

    return register


def r6(c: Column | str) -> Column:
    """Rounded for comparison between engines; adding 0 turns -0 into 0."""
    return F.round(c, 6) + F.lit(0.0)


def bars(c: Column | str) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), "|")


def stamp(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def long_vector(df: DataFrame, *keys: str, col: str = "embedding") -> DataFrame:
    """One row per element (keys..., dim, val), dims from 1."""
    return df.select(*keys, F.posexplode(col).alias("p", "x")).select(
        *keys, (F.col("p") + 1).cast("bigint").alias("dim"), r6("x").alias("val"))
