"""Global order without a global task: positions, running totals, exact quantiles and top rows.

A window without PARTITION BY moves every row into one task. Here rows are range-partitioned by the full
order key, so that equal leading values (a score shared by a third of all rows) still spread by the last,
unique column. Each range is summed on its own, and the sums of earlier ranges are added from a table with
one row per range.
"""

from __future__ import annotations

import os.path

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphatlas.session import cut_lineage, discard, settle, shuffle_width

# Spark keeps the rows of a sorted limit on the driver: use it only up to this many.
DRIVER_LIMIT = 50_000


def running_totals(df: DataFrame, order: list[Column], totals: dict[str, Column]) -> DataFrame:
    """Add per name the total of its column over all rows that come before the row in `order`.

    `order` must be a total order (end it with a unique column). The laid-out rows are checkpointed, because
    the ranges are sampled and must be the same for the offsets and for the rows.
    """
    named = df.select("*", *[c.alias(f"_v_{k}") for k, c in totals.items()])
    ranged = named.repartitionByRange(shuffle_width(df.sparkSession), *order)
    laid = cut_lineage(ranged.withColumn("_range", F.spark_partition_id()))
    before = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inner = laid.select("*", *[F.sum(f"_v_{k}").over(before).alias(f"_in_{k}") for k in totals])
    per_range = laid.groupBy("_range").agg(*[F.sum(f"_v_{k}").alias(f"_s_{k}") for k in totals])
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    offsets = per_range.select("_range", *[F.sum(f"_s_{k}").over(earlier).alias(f"_off_{k}") for k in totals])
    out = inner.join(F.broadcast(offsets), "_range")
    zero = F.lit(0)
    return out.select(
        *df.columns,
        *[(F.coalesce(f"_in_{k}", zero) + F.coalesce(f"_off_{k}", zero)).alias(k) for k in totals],
    )


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """0-based place of every row in `order`."""
    return running_totals(df, order, {name: F.lit(1).cast("bigint")})


def top_rows(df: DataFrame, n: int, order: list[Column], key: str = "id") -> DataFrame:
    """The first `n` rows in a total order, with unique `key`.

    Up to DRIVER_LIMIT rows the keys come from a sorted limit, which reads and moves only the columns of the
    order; beyond it from positions. The wide rows are picked by key and never meet in one task.
    """
    if n <= DRIVER_LIMIT:
        keys = df.orderBy(*order).limit(n).select(key)
    else:
        keys = with_position(df, order, "_pos").where(F.col("_pos") < n).select(key)
    return df.join(keys, key, "left_semi").select(*df.columns)


def place_key(levels: list[Column], score: Column, key: Column, digits: int) -> Column:
    """One string per row whose order is: the flags of `levels` (true first), the rounded score (highest first, nulls last), the bytes of the key.

    Scores are below 2^62 / 10^digits in size. Four hexadecimal places of it take few values, whatever the rows hold.
    """
    flags = [F.when(c, "0").otherwise("1") for c in levels]
    whole = F.round(F.round(score, digits) * F.lit(10.0**digits)).cast("bigint")
    turned = F.hex(F.lit(2**62) - whole)
    return F.concat(*flags, F.coalesce(F.lpad(turned, 16, "0"), F.lit("G" * 16)), F.coalesce(F.hex(F.encode(key.cast("string"), "UTF-8")), F.lit("")))


def nth_key(keys: DataFrame, n: int, room: int = DRIVER_LIMIT) -> str | None:
    """The `n`-th of the strings in the only column of `keys`, which `place_key` made, counted from 1; None if there are fewer.

    Rows are counted per next four places behind a common beginning, at most some 65,000 counts, until the group that holds the n-th has at
    most `room` rows; only these are sorted. No sort or limit grows with `n` or with the rows that share a score.
    """
    name = keys.columns[0]
    written = settle(keys.where(F.col(name).isNotNull()))
    ends = written.agg(F.count(F.lit(1)), F.min(name), F.max(name)).first()
    if n < 1 or n > ends[0]:
        discard(written)
        return None
    begin, left, size = os.path.commonprefix([ends[1], ends[2]]), n, ends[0]
    while size > room:
        rows = written.where(F.col(name).startswith(begin))
        groups = rows.groupBy(F.substring(name, len(begin) + 1, 4).alias("g")).count().collect()
        for g, size in sorted((r["g"], r["count"]) for r in groups):
            if left <= size:
                break
            left -= size
        if g == "":  # all keys of this group are the same
            break
        begin += g
    rows = written.where(F.col(name).startswith(begin))
    found = begin if size > room else rows.orderBy(name).limit(left).agg(F.max(name)).first()[0]
    discard(written)
    return found


def grouped_quantiles(df: DataFrame, by: list[str], col: str, qs: dict[str, float]) -> DataFrame:
    """Linearly interpolated exact quantiles of `col` per group.

    Equal values are counted before sorting, so neither a hot group nor a hot value is ever held in one
    task; the sorted counts give the place of every distinct value.
    """
    counted = df.where(F.col(col).isNotNull()).groupBy(*by, F.col(col).alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_totals(counted, [*map(F.col, by), F.col("_x")], {"_before": F.col("_n")})
    span = placed.groupBy(*by).agg(F.sum("_n").alias("_t"), F.min("_before").alias("_start"))
    placed = placed.join(span, by)
    begin = F.col("_before") - F.col("_start")
    picks = []
    for name, q in qs.items():
        spot = (F.col("_t") - 1) * F.lit(float(q))
        at = lambda p: F.max(F.when((begin <= p) & (p < begin + F.col("_n")), F.col("_x").cast("double")))
        low, high = at(F.floor(spot)), at(F.ceil(spot))
        picks.append((low + (high - low) * F.max(spot - F.floor(spot))).alias(name))
    return placed.groupBy(*by).agg(*picks)


def exact_quantiles(df: DataFrame, col: str, qs: dict[str, float]) -> DataFrame:
    """One row with the quantiles of `col`."""
    one = df.select(F.lit(0).alias("_g"), F.col(col).alias("_c"))
    return grouped_quantiles(one, ["_g"], "_c", qs).drop("_g")
