"""Substring search over an index: positions of trigrams, and the texts split by their key.

`write_postings` lays out two tables below a folder: `postings` (gram, keys, places), split by a hash of the gram and sorted by it, and `texts` (key, text),
split by a hash of the key. A row of postings holds all places of a gram in about 1 MB of texts. Texts are moved and postings are not: every task
writes the postings of its texts to files of its own, in each part. A search reads the grams of the query only, keeps the keys where all of them stand at their distance from one start,
and compares the texts of these keys. It finds what `contains_text` finds by reading all texts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glyphatlas.functions.predicates import contains_text

GRAM = 3
BUCKETS = 64
# Bytes of text that a task packs at a time; a longer text is packed alone.
PIECE = 1 << 20
# Bytes of text whose postings a task sorts and writes, about twelve times as many bytes in memory; smaller tables are spread over the cores.
SHARE, SMALL_SHARE = 80 << 20, 10 << 20


def _bucket(c: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c.cast("string")), F.lit(buckets)).cast("int")


def trigrams(text: Column) -> Column:
    """Array of (pos, gram) of the lower-cased text, one per start; empty for null and for texts under three characters."""
    chars = F.split(F.lower(F.coalesce(text, F.lit(""))), "")
    # The array of one binds the characters, which would otherwise be split again for every start.
    starts = F.transform(F.array(chars), lambda cs: F.transform(cs, lambda c, i: F.struct(
        i.alias("pos"), F.concat(c, *[F.get(cs, i + F.lit(k)) for k in range(1, GRAM)]).alias("gram"))))
    return F.filter(F.get(starts, F.lit(0)), lambda s: F.char_length(s["gram"]) == GRAM)


def packed(rows: DataFrame) -> DataFrame:
    """(gram, keys, places) for (key, text): the trigrams of the lower-cased texts, a row for each gram and piece; keys[i] has the gram at places[i]."""
    kind = rows.schema["key"].dataType.simpleString()

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x.as_py() for x in batch.column(1)]
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.array([len(x) for x in texts], np.int64)
        row = np.repeat(np.arange(len(texts)), size)
        place = np.arange(len(chars)) - np.repeat(np.cumsum(size) - size, size)
        start = np.flatnonzero(place + GRAM <= size[row])
        code = np.zeros(len(start), np.int64)
        for i in range(GRAM):
            code = code << 21 | chars[start + i]
        order = np.argsort(code, kind="stable")
        code, start = code[order], start[order]
        first = np.flatnonzero(np.diff(code, prepend=-1))
        each = np.stack([code[first] >> 21 * i & (1 << 21) - 1 for i in reversed(range(GRAM))], 1)
        grams = each.astype("<u4").tobytes().decode("utf-32-le")
        ends = pa.array(np.append(first, len(code)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([grams[i:i + GRAM] for i in range(0, len(grams), GRAM)], pa.string()),
             pa.ListArray.from_arrays(ends, batch.column(0).take(pa.array(row[start]))),
             pa.ListArray.from_arrays(ends, pa.array(place[start], pa.int32()))],
            ["gram", "keys", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum([0, *(len(x.as_buffer()) for x in batch.column(1))])
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(size, size[at] + PIECE, "right")) - 1)
                yield pack(batch.slice(at, to - at))
                at = to

    return rows.select("key", F.lower("text").alias("text")).mapInArrow(run, f"gram string, keys array<{kind}>, places array<int>")


def write_postings(df: DataFrame, path: str, key: str, text: str, buckets: int = BUCKETS) -> None:
    """Index the whole texts of `df` below `path`, which must not exist.

    Texts are spread evenly for the postings, so the places of a gram that most texts hold are spread as well; the texts themselves are dealt by
    bucket through a rebalance. Rows with a null key are indexed as well; keys may repeat, then each row counts for itself when the texts are compared. Null texts are never found.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, total // SHARE, min(df.sparkSession.sparkContext.defaultParallelism, total // SMALL_SHARE))
    laid = packed(rows.repartition(tasks)).withColumn("bucket", _bucket(F.col("gram"), buckets)).sortWithinPartitions("bucket", "gram")
    laid.write.partitionBy("bucket").parquet(f"{path}/postings")
    texts = rows.withColumn("bucket", _bucket(F.coalesce(F.col("key").cast("string"), F.lit("")), buckets)).hint("rebalance", "bucket")
    texts.write.partitionBy("bucket").parquet(f"{path}/texts")
    spark = df.sparkSession
    spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(rows.schema.json()).alias("schema")).coalesce(1).write.json(f"{path}/about")


def _about(spark: SparkSession, path: str):
    return spark.read.schema("buckets int, schema string").json(f"{path}/about").first()


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def candidates(spark: SparkSession, path: str, query: str) -> DataFrame:
    """(key) of the texts where the grams of a query of at least three characters stand one behind the other; only these grams are read."""
    about = _about(spark, path)
    key_type = _key_type(about["schema"])
    asked = spark.range(1).select(F.inline(trigrams(F.lit(query)))).select(F.col("pos").alias("place"), "gram")
    rows = asked.withColumn("bucket", _bucket(F.col("gram"), about["buckets"])).collect()  # one row per character of the query
    if not rows:
        raise ValueError(f"a query needs at least {GRAM} characters to have candidates")
    held = _table(spark, f"{path}/postings", f"gram string, keys array<{key_type}>, places array<int>, bucket int")
    held = held.where(F.col("bucket").isin(sorted({r["bucket"] for r in rows})) & F.col("gram").isin(sorted({r["gram"] for r in rows})))
    held = held.select("gram", F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("places").alias("pos"))))
    places = F.create_map(*[x for gram in sorted({r["gram"] for r in rows}) for x in (
        F.lit(gram), F.array(*[F.lit(r["place"]) for r in rows if r["gram"] == gram]))])
    starts = held.select("key", "pos", F.explode(F.element_at(places, F.col("gram"))).alias("place")).select("key", (F.col("pos") - F.col("place")).alias("start"))
    full = starts.groupBy("key", "start").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= len(rows))
    return full.select("key").distinct()


def search_postings(spark: SparkSession, path: str, query: str) -> DataFrame:
    """(key, text) of every indexed row whose text holds the query, in any case.

    Only the parts of `texts` that hold candidates are opened, and each candidate is compared on its text. A query under three
    characters has no gram: it is compared with all texts.
    """
    about = _about(spark, path)
    texts = _table(spark, f"{path}/texts", f"key {_key_type(about['schema'])}, text string, bucket int")
    if len(query.lower()) >= GRAM:
        found = candidates(spark, path, query)
        named = _bucket(F.coalesce(F.col("key").cast("string"), F.lit("")), about["buckets"])
        parts = [r[0] for r in found.select(named.alias("b")).distinct().collect()]  # at most as many as there are buckets
        texts = texts.where(F.col("bucket").isin(parts) if parts else F.lit(False))
        texts = texts.join(found.withColumnRenamed("key", "_key"), F.col("key").eqNullSafe(F.col("_key")), "left_semi")
    return texts.where(contains_text(F.col("text"), query)).select("key", "text")


def _key_type(schema: str) -> str:
    return StructType.fromJson(json.loads(schema))["key"].dataType.simpleString()
