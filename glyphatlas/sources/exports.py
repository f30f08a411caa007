"""Flat and nested text exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted CSV with a header in every part; line breaks inside values survive."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv(spark, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(schema).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def as_json(df: DataFrame, name: str = "json") -> DataFrame:
    """Every row as one JSON document."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))
