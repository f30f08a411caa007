"""Agreement of two annotators over a set of categorical fields.

A null on either side is neither a match nor a disagreement, as in SQL. The fields are unpivoted once and
every report is one grouped aggregate over (field, a, b).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphatlas.operators.ranking import top_rows
from glyphatlas.vocab import ENUM_FIELDS, PRICES

NULL_LABEL = "(null)"


def join_annotators(a: DataFrame, b: DataFrame, fields=ENUM_FIELDS, key: str = "id", base=("name", "values_preview_str")):
    """Inner join on the key; fields are prefixed `a_` and `b_`, base columns come from `a`."""
    left = a.select(key, *[c for c in base if c in a.columns], *[F.col(f).alias(f"a_{f}") for f in fields])
    right = b.select(key, *[F.col(f).alias(f"b_{f}") for f in fields])
    return left.join(right, key)


def _long(joined: DataFrame, fields) -> DataFrame:
    pairs = ", ".join(f"'{f}', a_{f}, b_{f}" for f in fields)
    return joined.select(F.expr(f"stack({len(fields)}, {pairs}) AS (field, a, b)"))


def agreement(joined: DataFrame, fields=ENUM_FIELDS) -> DataFrame:
    total = F.count(F.lit(1))
    matches = F.count_if(F.col("a") == F.col("b"))
    return _long(joined, fields).groupBy("field").agg(
        matches.alias("matches"),
        total.alias("total"),
        F.round(100.0 * matches / total, 1).alias("agreement_pct"),
        F.count_if(F.col("a").isNull()).alias("a_nulls"),
        F.count_if(F.col("b").isNull()).alias("b_nulls"),
    )


def distribution(joined: DataFrame, fields=ENUM_FIELDS) -> DataFrame:
    """(field, value, a_n, a_pct, b_n, b_pct) over the values of either side; counts before pairing sides."""
    pairs = _long(joined, fields).groupBy("field", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select("field", F.expr("stack(2, a, n, 0L, b, 0L, n) AS (value, na, nb)"))
    counts = sides.groupBy("field", F.coalesce("value", F.lit(NULL_LABEL)).alias("value")).agg(
        F.sum("na").alias("a_n"), F.sum("nb").alias("b_n"))
    total = joined.agg(F.count(F.lit(1))).scalar()
    pct = lambda c: F.round(100.0 * F.col(c) / total, 1)
    return counts.select("field", "value", "a_n", pct("a_n").alias("a_pct"), "b_n", pct("b_n").alias("b_pct"))


def confusion(joined: DataFrame, fields=ENUM_FIELDS) -> DataFrame:
    """Long confusion matrix (field, a, b, n); pivot `b` over the known domain for the wide form."""
    named = lambda c: F.coalesce(c, F.lit(NULL_LABEL)).alias(c)
    return _long(joined, fields).groupBy("field", named("a"), named("b")).agg(F.count(F.lit(1)).alias("n"))


def confusion_wide(joined: DataFrame, field: str, domain: tuple[str, ...]) -> DataFrame:
    return confusion(joined, (field,)).groupBy("a").pivot("b", [*domain, NULL_LABEL]).agg(F.sum("n")).na.fill(0)


def n_disagree(fields=ENUM_FIELDS) -> Column:
    one = lambda f: F.coalesce((F.col(f"a_{f}") != F.col(f"b_{f}")).cast("bigint"), F.lit(0))
    return sum((one(f) for f in fields), F.lit(0).cast("bigint"))


def disagreements(joined: DataFrame, fields=ENUM_FIELDS) -> DataFrame:
    return joined.withColumn("n_disagree", n_disagree(fields)).where("n_disagree > 0")


def top_disagreements(joined: DataFrame, fields=ENUM_FIELDS, n: int = 30) -> DataFrame:
    return top_rows(disagreements(joined, fields), n, [F.col("n_disagree").desc(), F.col("id")])


def disagree_hist(joined: DataFrame, fields=ENUM_FIELDS) -> DataFrame:
    return disagreements(joined, fields).groupBy("n_disagree").agg(F.count(F.lit(1)).alias("n_rows"))


def completeness(df: DataFrame, by: str, fields=ENUM_FIELDS) -> DataFrame:
    """Rows, complete rows and rows with any null field, per run."""
    full = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0)) == len(fields)
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(full).alias("n_complete"), F.count_if(~full).alias("n_null"))


def price_columns(model: Column, prices: dict[str, tuple[float, float]] = PRICES) -> tuple[Column, Column]:
    """Input and output price of a model from a literal map; null if unknown."""
    table = lambda i: F.create_map(*[F.lit(x) for m, p in prices.items() for x in (m, p[i])])
    return F.try_element_at(table(0), model), F.try_element_at(table(1), model)


def estimate_cost(model: Column, tokens_in: Column, tokens_out: Column, prices=PRICES) -> Column:
    price_in, price_out = price_columns(model, prices)
    return F.coalesce(tokens_in / 1e6 * price_in + tokens_out / 1e6 * price_out, F.lit(0.0))


def usage_summary(usage: DataFrame, prices=PRICES) -> DataFrame:
    """Token totals and cost per model. Usage is data, not accumulators, so retried tasks do not count twice."""
    sums = usage.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
    )
    cost = estimate_cost(F.col("model"), F.col("input_tokens"), F.col("output_tokens"), prices)
    return sums.withColumn("cost_usd", cost)
