"""Annotator agreement, validation and cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from glyphatlas.catalog import inputs as I
from glyphatlas.catalog import sql as S
from glyphatlas.catalog.registry import query, r6
from glyphatlas.operators import agreement as A
from glyphatlas.operators import inference as M
from glyphatlas.sources.exports import as_json
from glyphatlas.vocab import ENUM_FIELDS


def joined(spark, sf):
    return A.join_annotators(I.annotator(spark, sf, "a"), I.annotator(spark, sf, "b"))


_PAIRS = ", ".join(f"{side}_{f}" for f in ENUM_FIELDS for side in "ab")
_DIFF = " + ".join(f"coalesce((a_{f} <> b_{f})::BIGINT, 0)" for f in ENUM_FIELDS)


@query("annotator_join", f"WITH {S.ANNOTATORS} SELECT id, name, values_preview_str, {_PAIRS} FROM ann")
def _join(spark, sf):
    return joined(spark, sf)


@query("agreement", f"""WITH {S.ANNOTATORS} SELECT field, count(*) FILTER (a = b) AS matches, count(*) AS total,
  round(100.0 * count(*) FILTER (a = b) / count(*), 1) AS agreement_pct, count(*) FILTER (a IS NULL) AS a_nulls,
  count(*) FILTER (b IS NULL) AS b_nulls FROM fields GROUP BY field""")
def _agreement(spark, sf):
    return A.agreement(joined(spark, sf))


@query("distribution", f"""WITH {S.ANNOTATORS}, s AS (SELECT field, coalesce(a, '(null)') AS value, 1 AS x, 0 AS y FROM fields
  UNION ALL SELECT field, coalesce(b, '(null)'), 0, 1 FROM fields)
SELECT field, value, sum(x)::BIGINT AS a_n, round(100.0 * sum(x) / (SELECT count(*) FROM ann), 1) AS a_pct, sum(y)::BIGINT AS b_n,
  round(100.0 * sum(y) / (SELECT count(*) FROM ann), 1) AS b_pct FROM s GROUP BY field, value""")
def _distribution(spark, sf):
    return A.distribution(joined(spark, sf))


@query("confusion", f"""WITH {S.ANNOTATORS} SELECT field, coalesce(a, '(null)') AS a, coalesce(b, '(null)') AS b, count(*) AS n
FROM fields GROUP BY ALL""")
def _confusion(spark, sf):
    return A.confusion(joined(spark, sf))


@query("disagree_hist", f"""WITH {S.ANNOTATORS}, n AS (SELECT {_DIFF} AS n_disagree FROM ann)
SELECT n_disagree, count(*) AS n_rows FROM n WHERE n_disagree > 0 GROUP BY n_disagree""")
def _hist(spark, sf):
    return A.disagree_hist(joined(spark, sf))


@query("top_disagreements", f"""WITH {S.ANNOTATORS}, n AS (SELECT *, {_DIFF} AS n_disagree FROM ann)
SELECT id, name, values_preview_str, {_PAIRS}, n_disagree FROM n WHERE n_disagree > 0 ORDER BY n_disagree DESC, id LIMIT 30""")
def _top(spark, sf):
    return A.top_disagreements(joined(spark, sf))


@query("agreement_json", f"""WITH {S.ANNOTATORS}, g AS (SELECT field, count(*) FILTER (a = b) AS matches, count(*) AS total FROM fields GROUP BY field)
SELECT '{{"field":"' || field || '","matches":' || matches || ',"total":' || total || '}}' AS json FROM g""")
def _json(spark, sf):
    return as_json(A.agreement(joined(spark, sf)).select("field", "matches", "total"))


@query("validate_enum", f"""WITH {S.ANNOTATORS} SELECT id, CASE WHEN b_math_domain = 'chemistry_physics' THEN 'other' ELSE b_math_domain END
  AS math_domain, b_sequence_type AS sequence_type, b_growth_class AS growth_class, b_origin_era AS origin_era FROM ann""")
def _validate(spark, sf):
    return M.validated(I.annotator(spark, sf, "b")).select("id", *ENUM_FIELDS)


@query("completeness", f"""WITH {S.ANNOTATORS}, c AS (
  SELECT 'a' AS run, a_growth_class IS NOT NULL AS ok FROM ann
  UNION ALL SELECT 'b', b_math_domain IS NOT NULL AND b_growth_class IS NOT NULL FROM ann)
SELECT run, count(*) AS n_rows, count(*) FILTER (ok) AS n_complete, count(*) FILTER (NOT ok) AS n_null FROM c GROUP BY run""")
def _complete(spark, sf):
    runs = [I.annotator(spark, sf, w).withColumn("run", F.lit(w)) for w in "ab"]
    return A.completeness(runs[0].unionByName(runs[1]), "run")


def _usage(spark, sf):
    """Turns of conversations as model calls: characters as tokens, role as model tier."""
    return I.table(spark, sf, "conversations").selectExpr(
        "conv_id", "turn", "CASE turn % 4 WHEN 0 THEN 'small' WHEN 1 THEN 'medium' WHEN 2 THEN 'large' ELSE 'not listed' END AS model",
        "cast(length(text) as bigint) AS input_tokens", "cast(octet_length(text) as bigint) AS output_tokens")


_CALLS = """c AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'small' WHEN 1 THEN 'medium' WHEN 2 THEN 'large' ELSE 'not listed' END AS model,
  length(text) AS i, strlen(text) AS o FROM conversations)"""
_COST = "CASE model WHEN 'small' THEN {i} * 1.0 + {o} * 5 WHEN 'medium' THEN {i} * 3.0 + {o} * 15 WHEN 'large' THEN {i} * 15.0 + {o} * 75 ELSE 0 END / 1e6"


@query("cost_estimate", f"WITH {_CALLS} SELECT conv_id, turn, model, round({_COST.format(i='i', o='o')}, 6) AS cost_usd FROM c")
def _cost(spark, sf):
    cost = A.estimate_cost(F.col("model"), F.col("input_tokens"), F.col("output_tokens"))
    return _usage(spark, sf).select("conv_id", "turn", "model", r6(cost).alias("cost_usd"))


@query("usage_summary", f"""WITH {_CALLS} SELECT model, count(*) AS n_calls, sum(i)::BIGINT AS input_tokens, sum(o)::BIGINT AS output_tokens,
  round({_COST.format(i='sum(i)', o='sum(o)')}, 6) AS cost_usd FROM c GROUP BY model""")
def _summary(spark, sf):
    return A.usage_summary(_usage(spark, sf)).withColumn("cost_usd", r6("cost_usd"))
