"""Exclusion, scoring, selection, sampling, and composed texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from glyphatlas.catalog import inputs as I
from glyphatlas.catalog import sql as S
from glyphatlas.catalog.registry import query, r6
from glyphatlas.functions import compose as C
from glyphatlas.functions.predicates import is_seed
from glyphatlas.operators import inference as M
from glyphatlas.operators import selection as L
from glyphatlas.vocab import CONTENT_KEYWORDS

# The target and sample sizes of the catalog: small enough to leave rows out at every scale.
TARGET = 120
SAMPLE = 50
WATCH = ("A000001", "A000010", "A000040", "A000045", "A000079", "A000108", "A000142")


def _scored(spark, sf, scope):
    return L.select(I.records(spark, sf), scope, TARGET)


@query("hard_exclude", f"WITH {S.RECORDS} SELECT id, name, n_terms_visible FROM k WHERE NOT out")
def _exclude(spark, sf):
    return L.hard_exclude(I.records(spark, sf)).select("id", "name", "n_terms_visible")


@query("exclude_audit", f"""WITH {S.RECORDS} SELECT reason, n_rows FROM (
  SELECT 'keyword=dead' AS reason, count(*) FILTER (toxic = 1) AS n_rows FROM k
  UNION ALL SELECT unnest(['keyword=dupe', 'keyword=uned', 'keyword=dumb']), 0
  UNION ALL SELECT 'n_terms<8', count(*) FILTER (n_terms_visible < 8) FROM k
  UNION ALL SELECT 'empty name', count(*) FILTER (name = '') FROM k
  UNION ALL SELECT 'any reason', count(*) FILTER (out) FROM k
  UNION ALL SELECT 'kept', count(*) FILTER (NOT out) FROM k)""")
def _audit(spark, sf):
    return L.exclude_audit(I.records(spark, sf))


@query("quality_score", f"WITH {S.RECORDS} SELECT id, round(score, 6) AS score FROM k")
def _score(spark, sf):
    return I.records(spark, sf).select("id", r6(L.quality_score()).alias("score"))


@query("scope_core", f"WITH {S.RECORDS} SELECT id, round(score, 6) AS select_score, 'core' AS scope FROM k WHERE NOT out AND is_core")
def _core(spark, sf):
    return _scored(spark, sf, "core").select("id", r6("select_score").alias("select_score"), "scope")


@query("scope_all", f"WITH {S.RECORDS} SELECT id, round(score, 6) AS select_score, 'all' AS scope FROM k WHERE NOT out")
def _all(spark, sf):
    return _scored(spark, sf, "all").select("id", r6("select_score").alias("select_score"), "scope")


_CURATED = f"""cur AS (SELECT * FROM k WHERE NOT out ORDER BY is_seed DESC, round(score, 9) DESC, id LIMIT {TARGET})"""


@query("scope_curated", f"WITH {S.RECORDS}, {_CURATED} SELECT id, round(score, 6) AS select_score, 'curated' AS scope FROM cur")
def _curated(spark, sf):
    return _scored(spark, sf, "curated").select("id", r6("select_score").alias("select_score"), "scope")


def _curated_sql(places: str) -> str:
    return f"""WITH {S.RECORDS}, ranked AS (SELECT *, row_number() OVER (ORDER BY is_seed DESC, round(score, 9) DESC, id) AS place FROM k WHERE NOT out),
c AS (SELECT count(*) AS n, count(*) FILTER (is_seed) AS seeds FROM ranked)
SELECT id, is_seed, round(score, 6) AS select_score FROM ranked, c WHERE place <= {places}"""


def _curated_part(spark, sf, places):
    rows = I.records(spark, sf)
    n, seeds = L.hard_exclude(rows).agg(F.count(F.lit(1)), F.count_if(is_seed())).first()
    return L.select(rows, "curated", places(n, seeds)).select("id", is_seed().alias("is_seed"), r6("select_score").alias("select_score"))


@query("scope_curated_top_up", _curated_sql("seeds + (n - seeds) // 2"))
def _top_up(spark, sf):
    """All seeds, and half of the other rows by score: the target is a share of the rows."""
    return _curated_part(spark, sf, lambda n, seeds: seeds + (n - seeds) // 2)


@query("scope_curated_best_seeds", _curated_sql("seeds // 2"))
def _best_seeds(spark, sf):
    """Fewer places than seeds: the best half of the seeds."""
    return _curated_part(spark, sf, lambda n, seeds: seeds // 2)


@query("select_report", f"""WITH {S.RECORDS}, {_CURATED} SELECT count(*) AS n_selected, round(min(score), 6) AS score_min,
  round(max(score), 6) AS score_max, count(*) FILTER (id IN {WATCH}) AS watch_present, {len(WATCH)}::BIGINT AS watch_total,
  round(median(score), 6) AS score_median FROM cur""")
def _report(spark, sf):
    watch = spark.createDataFrame([(w,) for w in WATCH], "id string")
    out = L.select_report(_scored(spark, sf, "curated"), watch)
    return out.withColumns({c: r6(c) for c in ("score_min", "score_max", "score_median")})


@query("head_tail", f"""WITH {S.RECORDS}, s AS (SELECT id, round(score, 6) AS select_score,
    row_number() OVER (ORDER BY round(score, 9) DESC, id) AS a, row_number() OVER (ORDER BY round(score, 9), id DESC) AS b,
    count(*) OVER () AS n FROM k WHERE NOT out)
SELECT 'head' AS part, id, select_score FROM s WHERE a <= 8 UNION ALL SELECT 'tail', id, select_score FROM s WHERE b <= 8 AND n > 16""")
def _ends(spark, sf):
    return L.head_tail(_scored(spark, sf, "all")).withColumn("select_score", r6("select_score"))


@query("sample_n", f"""WITH {S.RECORDS} SELECT id, name, comments, formulas, array_to_string(keywords, '|') AS keywords, "offset",
  values_preview_str, author, edit_year FROM k WHERE NOT out ORDER BY md5('42:' || id), id LIMIT {SAMPLE}""")
def _sample(spark, sf):
    rows = L.sample_n(I.records(spark, sf), SAMPLE, 42)
    return rows.withColumn("keywords", F.array_join("keywords", "|")).withColumn(
        "edit_year", F.year("last_edited").cast("bigint")).drop("last_edited")


@query("signal_auc", f"""WITH {S.RECORDS}, s AS (
  SELECT toxic, unnest([{{'s': 'n_langs', 'x': n_langs::DOUBLE}}, {{'s': 'n_references', 'x': n_references::DOUBLE}},
    {{'s': 'n_links', 'x': n_links::DOUBLE}}, {{'s': 'edit_count', 'x': edit_count::DOUBLE}},
    {{'s': 'has_code', 'x': (n_langs > 0)::DOUBLE}}]) AS u FROM k WHERE toxic IS NOT NULL),
w AS (SELECT u.s AS signal, toxic, rank() OVER (PARTITION BY u.s ORDER BY u.x)
    + (count(*) OVER (PARTITION BY u.s, u.x) - 1) / 2.0 AS rk FROM s)
SELECT signal, sum(toxic)::BIGINT AS n_pos, sum(1 - toxic)::BIGINT AS n_neg,
  round((sum(rk) FILTER (toxic = 1) - sum(toxic) * (sum(toxic) + 1) / 2.0) / (sum(toxic) * sum(1 - toxic)), 6) AS auc
FROM w GROUP BY signal""")
def _auc(spark, sf):
    rows = I.records(spark, sf).withColumn("n_langs", F.size("code_languages"))
    rows = rows.withColumn("has_code", (F.col("n_langs") > 0).cast("int"))
    return L.signal_auc(rows, ["n_langs", "n_references", "n_links", "edit_count", "has_code"], "toxic").withColumn("auc", r6("auc"))


# --- composed texts ---------------------------------------------------------------------------

_DROP = "(" + ", ".join(f"'{k}'" for k in (*CONTENT_KEYWORDS, "nonn", "dead", "dupe", "uned", "dumb")) + ")"


@query("embed_text", f"""WITH {S.RECORDS} SELECT id, 'Name: ' || left(name, 300) || chr(10) || 'Keywords: '
  || array_to_string(list_filter(keywords, lambda w: w NOT IN {_DROP}), ', ') || chr(10) || 'First values: ' || values_preview_str
  || chr(10) || 'Description:' || chr(10) || left(comments, 1500) || chr(10) || 'Formula: ' || left(formulas, 500) || chr(10)
  || 'Examples:' || chr(10) || left(examples, 300) AS text FROM k""")
def _embed_text(spark, sf):
    return I.records(spark, sf).select("id", C.embed_text().alias("text"))


@query("topic_doc", f"""WITH {S.RECORDS} SELECT id, name || ' — first values ' || values_preview_str || chr(10) || left(comments, 200)
  AS text FROM k""")
def _topic(spark, sf):
    return I.records(spark, sf).select("id", C.topic_doc().alias("text"))


@query("taxonomy_doc", f"""WITH {S.RECORDS} SELECT id, name || ' [' || array_to_string(keywords[1:6], ',') || '] ' || values_preview_str
  || chr(10) || left(comments, 150) || chr(10) || left(formulas, 150) AS text FROM k""")
def _taxonomy(spark, sf):
    return I.records(spark, sf).select("id", C.taxonomy_doc().alias("text"))


@query("search_text", f"""WITH {S.RECORDS} SELECT id, id || ' ' || name || ' ' || author_name || ' '
  || left(replace(comments, chr(10), ' '), 400) AS text FROM k""")
def _search(spark, sf):
    return I.records(spark, sf).select("id", C.search_text().alias("text"))


_BATCHES = f"""WITH {S.RECORDS}, b AS (
  SELECT *, (rn - 1) // 25 AS batch_id, (rn - 1) % 25 AS place
  FROM (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, id) AS rn FROM k WHERE NOT out))"""


def batches(spark, sf):
    return M.with_batches(_scored(spark, sf, "all"), L.score_order(), by=("id", "select_score"))


@query("batch_prompts", _BATCHES + """
SELECT batch_id, count(*) AS n_rows, 'Classify the following ' || count(*) || ' records. Return one classification per sequence using its 0-based index.'
  || chr(10) || string_agg(chr(10) || '--- Sequence ' || place || ' ---' || chr(10) || 'ID: ' || id || chr(10) || 'Name: ' || name
  || chr(10) || 'Offset: ' || "offset" || chr(10) || 'Values: ' || values_preview_str || chr(10) || 'Keywords: '
  || array_to_string(keywords, ', ') || chr(10) || 'Author: ' || coalesce(left(author, 100), '(unknown)') || chr(10)
  || 'LastEdited: ' || coalesce(edit_year::VARCHAR, '(unknown)') || chr(10) || 'Comments: ' || left(comments, 800) || chr(10)
  || 'Formula: ' || left(formulas, 400), chr(10) ORDER BY place) AS prompt FROM b GROUP BY batch_id""")
def _prompts(spark, sf):
    return M.batch_prompts(batches(spark, sf))


@query("classify_align", _BATCHES + f""", {S.ANNOTATORS}
SELECT b.id, CASE WHEN doc_id % 10 <> 3 THEN CASE WHEN b_math_domain = 'chemistry_physics' THEN 'other' ELSE b_math_domain END END AS math_domain,
  CASE WHEN doc_id % 10 <> 3 THEN b_sequence_type END AS sequence_type,
  CASE WHEN doc_id % 10 <> 3 THEN b_growth_class END AS growth_class,
  CASE WHEN doc_id % 10 <> 3 THEN b_origin_era END AS origin_era
FROM b JOIN ann USING (doc_id)""")
def _align(spark, sf):
    """Answers with repeats (the later one counts), gaps, and places that no row has."""
    rows = batches(spark, sf).select("doc_id", "id", "batch_id", "place")
    given = rows.join(I.annotator(spark, sf, "b").drop("id", "name", "values_preview_str"), "doc_id")
    keys = ["batch_id", F.col("place").alias("index")]
    late = given.where("doc_id % 10 <> 3").select(*keys, F.lit(2).alias("seq"), *M.ENUM_FIELDS)
    early = given.where("doc_id % 10 <> 3").select(
        *keys, F.lit(1).alias("seq"), *[F.lit("other").alias(f) for f in M.ENUM_FIELDS])
    outside = given.select("batch_id", (F.col("place") + 1000).alias("index"), F.lit(1).alias("seq"), *M.ENUM_FIELDS)
    return M.align_responses(rows, late.unionByName(early).unionByName(outside))


@query("classify_rules", f"""WITH {S.RECORDS}, w AS (SELECT *, lower(name || ' ' || coalesce(author, '')) AS s FROM k)
SELECT id, CASE WHEN doc_id % 7 = 2 THEN 'number_theory' WHEN doc_id % 3 = 0 THEN 'combinatorics'
    WHEN regexp_matches(s, '\\b(graph|tree|network)s?\\b') THEN 'graph_theory'
    WHEN regexp_matches(s, '\\b(area|volume|polytope)s?\\b') THEN 'geometry'
    WHEN regexp_matches(s, '\\b(prime|divisor)s?\\b') THEN 'number_theory' ELSE 'other' END AS math_domain,
  CASE WHEN doc_id % 3 = 0 THEN 'table_flattened' WHEN doc_id % 7 = 2 THEN 'arithmetic_function'
    WHEN regexp_matches(s, '\\bnumber of\\b') THEN 'enumeration' ELSE 'other' END AS sequence_type,
  CASE WHEN doc_id % 4 = 1 THEN 'oscillating' ELSE 'unknown' END AS growth_class,
  CASE WHEN regexp_matches(s, '\\b20[0-9][0-9]\\b') THEN 'modern_post2000' WHEN regexp_matches(s, '\\b19[5-9][0-9]\\b') THEN 'mid_20c_1950_2000'
    WHEN regexp_matches(s, '\\b19[0-4][0-9]\\b') THEN 'early_20c_1900_1950' WHEN regexp_matches(s, '\\b1[0-8][0-9][0-9]\\b') THEN 'classical_pre1900'
    ELSE 'unknown' END AS origin_era
FROM w""")
def _rules(spark, sf):
    return M.classify_by_rules(I.records(spark, sf)).select("id", *M.ENUM_FIELDS)


@query("hash_embed")
def _hash(spark, sf):
    docs = I.table(spark, sf, "documents", "doc_id").selectExpr("doc_id AS id", "text")
    return M.hash_embed(docs, 256).select("id", F.size("embedding").alias("dim"), "text_version", F.array_join(
        F.transform("embedding", lambda x: F.round(x, 4).cast("string")), ",").alias("embedding"))


@query("tfidf_terms", f"""WITH tf AS (SELECT id, term, count(*) AS tf FROM (SELECT doc_id AS id, unnest({S.WORDS}) AS term FROM documents) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT id, term, tf, df, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS tfidf FROM tf JOIN df USING (term)""")
def _tfidf(spark, sf):
    docs = I.table(spark, sf, "documents", "doc_id").selectExpr("doc_id AS id", "text")
    return M.tfidf_terms(docs).withColumn("tfidf", r6("tfidf"))
