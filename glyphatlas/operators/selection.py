"""Exclusion, quality score, scoped selection, sampling and score calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphatlas.functions.predicates import excluded, exclusion_reasons, is_seed
from glyphatlas.operators.ranking import exact_quantiles, nth_key, place_key, running_totals, top_rows
from glyphatlas.vocab import CURATED_TARGET, SAMPLE_COLUMNS, SCOPES, SCORE_WEIGHTS

# Scores are compared after rounding, so that equal inputs rank equally on every machine.
SCORE_DIGITS = 9


def hard_exclude(df: DataFrame) -> DataFrame:
    return df.where(~excluded())


def exclude_audit(df: DataFrame) -> DataFrame:
    """(reason, n_rows): rows per reason, then rows excluded by any reason and rows kept; one pass."""
    counts = {name: F.count_if(test) for name, test in exclusion_reasons().items()}
    counts["any reason"] = F.count_if(excluded())
    counts["kept"] = F.count_if(~excluded())
    one = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts.values())])
    pairs = ", ".join(f"'{name}', c{i}" for i, name in enumerate(counts))
    return one.select(F.expr(f"stack({len(counts)}, {pairs}) AS (reason, n_rows)"))


def quality_score(weights: dict[str, float] = SCORE_WEIGHTS) -> Column:
    length = lambda c: F.log1p(F.coalesce(F.length(c), F.lit(0)))
    parts = {
        "edit_count": F.log1p(F.col("edit_count").cast("double")),
        "comments": length("comments"),
        "formulas": length("formulas"),
        "examples": length("examples"),
        "code_languages": F.size("code_languages").cast("double"),
        "n_references": F.log1p(F.col("n_references").cast("double")),
    }
    return sum((F.lit(weights[k]) * c for k, c in parts.items()), F.lit(0.0))


def score_order() -> list[Column]:
    return [F.round("select_score", SCORE_DIGITS).desc(), F.col("id")]


def select(df: DataFrame, scope: str, target: int = CURATED_TARGET) -> DataFrame:
    """Records of a scope, scored. The curated scope takes the seed first and tops it up by score; with
    more seeds than places it takes the best seeds. One order (seed, score, id) covers both cases; the last place in it is found by
    refined counts, so the rows are filtered and neither sorted nor joined. Rows that repeat the id at the last place stay together.

    Exclusion comes before scoring, so only survivors are scored. Rows are not sorted here: sort by
    `score_order()` when writing or showing them.
    """
    if scope not in SCOPES:
        raise ValueError(f"unknown scope {scope!r}; expected one of {SCOPES}")
    kept = hard_exclude(df).withColumn("select_score", quality_score())
    if scope == "core":
        kept = kept.where(F.array_contains("keywords", "core"))
    elif scope == "curated":
        place = place_key([is_seed()], F.col("select_score"), F.col("id"), SCORE_DIGITS)
        last = nth_key(kept.select(place.alias("place")), target)
        if target < 1:
            kept = kept.where(F.lit(False))
        elif last is not None:
            kept = kept.where(place <= last)
    return kept.withColumn("scope", F.lit(scope))


def select_report(selected: DataFrame, watch: DataFrame) -> DataFrame:
    """One row: number selected, score range and median, and how many ids of the watch-list are present."""
    summary = selected.agg(
        F.count(F.lit(1)).alias("n_selected"),
        F.min("select_score").alias("score_min"),
        F.max("select_score").alias("score_max"),
        F.lit(selected.join(watch.select("id").distinct(), "id", "left_semi").agg(F.count(F.lit(1))).scalar()).alias(
            "watch_present"
        ),
        F.lit(watch.agg(F.count_distinct("id")).scalar()).alias("watch_total"),
        F.lit(exact_quantiles(selected, "select_score", {"m": 0.5}).scalar()).alias("score_median"),
    )
    return summary


def head_tail(selected: DataFrame, n: int = 8) -> DataFrame:
    """The `n` best and, where more than 2n rows exist, the `n` last rows, as (part, id, select_score)."""
    best, worst = score_order(), [F.round("select_score", SCORE_DIGITS), F.col("id").desc()]
    cols = selected.select("id", "select_score")
    top = cols.orderBy(*best).limit(n).select(F.lit("head").alias("part"), "id", "select_score")
    total = selected.agg(F.count(F.lit(1))).scalar()
    last = cols.where(total > 2 * n).orderBy(*worst).limit(n)
    return top.unionByName(last.select(F.lit("tail").alias("part"), "id", "select_score"))


def sample_order(seed: int, key: str = "id") -> list[Column]:
    """A reproducible shuffle that does not depend on partitioning: order by a keyed digest."""
    return [F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), F.col(key)]


def sample_n(df: DataFrame, n: int, seed: int, columns: tuple[str, ...] = SAMPLE_COLUMNS) -> DataFrame:
    """`n` eligible rows in digest order; an error if there are fewer."""
    eligible = hard_exclude(df)
    available = eligible.limit(n).count()
    if n > available:
        raise ValueError(f"asked for {n} rows but only {available} are eligible")
    keep = [c for c in columns if c in df.columns]
    return top_rows(eligible.select(*keep), n, sample_order(seed))


def signal_auc(df: DataFrame, signals: list[str], label: str) -> DataFrame:
    """(signal, n_pos, n_neg, auc): chance that a positive row outranks a negative one, ties counting half.

    Rows are first counted per signal value, so a value shared by most rows is one row of the ranking.
    """
    stacked = df.select(
        F.col(label).cast("boolean").alias("pos"),
        F.expr("stack({}, {}) AS (signal, x)".format(
            len(signals), ", ".join(f"'{s}', cast(`{s}` as double)" for s in signals))),
    )
    counted = stacked.where("x is not null and pos is not null").groupBy("signal", "x").agg(
        F.count_if("pos").alias("p"), F.count_if(~F.col("pos")).alias("q"))
    ranked = running_totals(counted, [F.col("signal"), F.col("x")], {"q_before": F.col("q")})
    sums = ranked.groupBy("signal").agg(
        F.sum("p").alias("n_pos"),
        F.sum("q").alias("n_neg"),
        F.min("q_before").alias("q_start"),
        F.sum(F.col("p") * (F.col("q_before") + F.col("q") / 2)).alias("wins"),
    )
    auc = (F.col("wins") - F.col("n_pos") * F.col("q_start")) / (F.col("n_pos") * F.col("n_neg"))
    return sums.select("signal", "n_pos", "n_neg", auc.alias("auc"))
