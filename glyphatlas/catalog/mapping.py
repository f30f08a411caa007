"""Display points, facets, neighbours, clusters and names."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from glyphatlas.catalog import inputs as I
from glyphatlas.catalog import sql as S
from glyphatlas.catalog.registry import query, r6
from glyphatlas.functions import display as D
from glyphatlas.functions.predicates import contains_text, facet_match
from glyphatlas.operators import density as Y
from glyphatlas.operators import hierarchy as H
from glyphatlas.operators import mapdata as M
from glyphatlas.operators import naming as T
from glyphatlas.operators import neighbors as B
from glyphatlas.operators import postings as X
from glyphatlas.session import run_folder, settle

_REC = f"WITH {S.RECORDS}"


@query("first_line", f"""{_REC}, f AS (SELECT id, formulas, list_filter(list_transform(string_split(formulas, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1] AS l FROM k)
SELECT id, CASE WHEN l IS NULL THEN '' WHEN length(l) <= 140 THEN l ELSE rtrim(left(l, 139)) || '…' END AS first_formula FROM f""")
def _first(spark, sf):
    return I.records(spark, sf).select("id", D.first_line(F.col("formulas")).alias("first_formula"))


@query("clean_author", f"{_REC} SELECT id, author_name FROM k")
def _author(spark, sf):
    return I.records(spark, sf).select("id", D.clean_author(F.col("author")).alias("author_name"))


_ESC = "replace(replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


@query("html_escape", f"SELECT page_id, {_ESC.format(c='html')} AS escaped FROM pages")
def _escape(spark, sf):
    return I.table(spark, sf, "pages").select("page_id", D.html_escape(F.col("html")).alias("escaped"))


@query("kw_format", f"{_REC} SELECT id, array_to_string(keywords, ', ') AS shown, array_to_string(keywords, '|') AS piped FROM k")
def _keywords(spark, sf):
    kw = F.col("keywords")
    return I.records(spark, sf).select("id", D.join_keywords(kw).alias("shown"), D.join_keywords(kw, "|").alias("piped"))


@query("log_channels", f"""{_REC} SELECT id, round(log10(greatest(edit_count, 1)), 6) AS log_edits, round(log10(n_references + 1), 6) AS log_refs FROM k""")
def _logs(spark, sf):
    return I.records(spark, sf).select("id", r6(D.log_edits(F.col("edit_count"))).alias("log_edits"),
                                       r6(D.log_references(F.col("n_references"))).alias("log_refs"))


_SIZES = "m AS (SELECT *, sqrt(greatest(edit_count, 1)) AS root, min(sqrt(greatest(edit_count, 1))) OVER () AS lo, max(sqrt(greatest(edit_count, 1))) OVER () AS hi FROM k)"


@query("marker_size", f"""{_REC}, {_SIZES} SELECT id, round(CASE WHEN hi - lo < 1e-9 THEN 9.0 ELSE 3 + 12 * (root - lo) / (hi - lo) END, 6) AS marker_size FROM m""")
def _marker(spark, sf):
    return M.marker_size(I.records(spark, sf), "edit_count").select("id", r6("marker_size").alias("marker_size"))


@query("category_palette", """WITH c AS (SELECT DISTINCT source AS value FROM documents),
p AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS position FROM c)
SELECT value, position, round((position * 137.508::DOUBLE) % 360, 3) AS hue FROM p""")
def _palette(spark, sf):
    return M.category_palette(I.table(spark, sf, "documents"), "source")


@query("null_channels", f"""{_REC}, {S.ANNOTATORS} SELECT k.id, coalesce(edit_year, 0) AS year, edit_count AS edits,
  coalesce(a_growth_class, 'unknown') AS growth FROM k JOIN ann USING (id)""")
def _nulls(spark, sf):
    return I.enriched(spark, sf).select(
        "id", D.year_or_zero(F.col("last_edited")).alias("year"), D.int_or_zero(F.col("edit_count")).alias("edits"),
        D.label_or_unknown(F.col("growth_class")).alias("growth"))


@query("topn_bucket", """WITH c AS (SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 10)
SELECT doc_id, CASE WHEN source IN (SELECT source FROM c) THEN source ELSE 'Other' END AS bucket FROM documents""")
def _bucket(spark, sf):
    return M.topn_bucket(I.table(spark, sf, "documents"), "source", "bucket").select("doc_id", "bucket")


# --- map points -----------------------------------------------------------------------------------


def coords(spark, sf):
    return I.records(spark, sf).selectExpr("id", "cast(doc_id % 100 as double) AS x", "cast(edit_count % 100 as double) AS y")


def point_labels(spark, sf):
    docs = I.records(spark, sf).selectExpr("id", "keywords[1] AS source", "keywords[0] AS lang", "doc_id")
    long = docs.selectExpr("id", "stack(2, 0, lang, 1, CASE WHEN doc_id % 10 = 0 THEN 'Unlabelled' ELSE source END) AS (layer, label)")
    return T.label_pivot(long, 2)


def points(spark, sf):
    return M.map_points(I.enriched(spark, sf), coords(spark, sf), point_labels(spark, sf))


_POINTS = f"""{_REC}, {S.ANNOTATORS}, {_SIZES},
top AS (SELECT author_name FROM k WHERE author_name <> '' GROUP BY author_name ORDER BY count(*) DESC, author_name LIMIT 10),
fl AS (SELECT id, list_filter(list_transform(string_split(formulas, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1] AS l FROM k),
pt AS (SELECT m.id AS id, (m.doc_id % 100)::DOUBLE AS x, (edit_count % 100)::DOUBLE AS y, lang AS label_layer_0,
  CASE WHEN m.doc_id % 10 = 0 THEN 'Unlabelled' ELSE source END AS label_layer_1, {_ESC.format(c='m.name')} AS name,
  {_ESC.format(c="CASE WHEN l IS NULL THEN '' WHEN length(l) <= 140 THEN l ELSE rtrim(left(l, 139)) || '…' END")} AS first_formula,
  m.values_preview_str AS values_preview_str, edit_count, n_references, author_name AS author,
  {_ESC.format(c="array_to_string(keywords, ', ')")} AS keywords,
  m.id || ' ' || m.name || ' ' || author_name || ' ' || replace(comments, chr(10), ' ') AS search_text,
  CASE WHEN author_name IN (SELECT author_name FROM top) THEN author_name ELSE 'Other' END AS author_filter,
  array_to_string(keywords, '|') AS keywords_filter, edit_count AS edits_filter, n_references AS refs_filter, n_links AS links_filter,
  coalesce(edit_year, 0) AS year_filter,
  round(CASE WHEN hi - lo < 1e-9 THEN 9.0 ELSE 3 + 12 * (root - lo) / (hi - lo) END, 6) AS marker_size,
  round(log10(greatest(edit_count, 1)), 6) AS log_edits, round(log10(n_references + 1), 6) AS log_refs,
  coalesce(a_math_domain, 'unknown') AS math_domain, coalesce(a_math_domain, 'unknown') AS domain_filter,
  coalesce(a_sequence_type, 'unknown') AS sequence_type, coalesce(a_sequence_type, 'unknown') AS type_filter,
  coalesce(a_growth_class, 'unknown') AS growth_class, coalesce(a_growth_class, 'unknown') AS growth_filter,
  coalesce(a_origin_era, 'unknown') AS origin_era, coalesce(a_origin_era, 'unknown') AS era_filter
  FROM m JOIN fl USING (id) JOIN ann USING (id))"""


@query("map_points", f"{_POINTS} SELECT * FROM pt")
def _points(spark, sf):
    return points(spark, sf).withColumns({c: r6(c) for c in ("marker_size", "log_edits", "log_refs")})


@query("points_labels", """SELECT 'A' || lpad(doc_id::VARCHAR, greatest(6, length(doc_id::VARCHAR))::INTEGER, '0') AS id, quality::BIGINT AS quality FROM documents LEFT JOIN labels USING (doc_id)""")
def _labels(spark, sf):
    named = "concat('A', lpad(cast(doc_id as string), greatest(6, length(cast(doc_id as string))), '0')) AS id"
    ids = I.table(spark, sf, "documents").selectExpr(named)
    return M.align_labels(ids, I.table(spark, sf, "labels").selectExpr(named, "cast(quality as bigint) AS quality"))


@query("facet_filter", f"""{_POINTS} SELECT id FROM pt WHERE author_filter IN ('Other', 'src1') AND (edit_count >= 500)
  AND year_filter BETWEEN 1995 AND 2020 AND list_has_any(string_split(keywords_filter, '|'), ['tabl', 'sign'])""")
def _filter(spark, sf):
    rows = points(spark, sf).withColumn("kw", F.split("keywords_filter", "\\|"))
    test = facet_match({"author_filter": ["Other", "src1"]}, {"edits_filter": (500, 2000, 2000), "year_filter": (1995, 2020, 2024)},
                       ["tabl", "sign"], "kw")
    return rows.where(test).select("id")


@query("text_search", "SELECT doc_id FROM documents WHERE contains(lower(text), 'the and')")
def _search(spark, sf):
    return I.table(spark, sf, "documents").where(contains_text(F.col("text"), "The and")).select("doc_id")


@query("text_search_postings", "SELECT doc_id FROM documents WHERE contains(lower(text), 'the and')")
def _search_index(spark, sf):
    """The same question through an index of all whole texts."""
    place = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    X.write_postings(I.table(spark, sf, "documents"), place, "doc_id", "text")
    return X.search_postings(spark, place, "The and").select(F.col("key").alias("doc_id"))


@query("facet_values", f"""{_POINTS}, f AS (SELECT DISTINCT unnest([{{'f': 'authors', 'v': author_filter}}, {{'f': 'domains', 'v': domain_filter}},
    {{'f': 'growths', 'v': growth_filter}}]) AS u FROM pt),
g AS (SELECT u.f AS facet, u.v AS value, CASE u.v WHEN 'unknown' THEN 1 WHEN 'Unknown' THEN 2 WHEN 'other' THEN 3 WHEN 'Other' THEN 4 ELSE 0 END AS t FROM f)
SELECT facet, value, row_number() OVER (PARTITION BY facet ORDER BY t, value) - 1 AS position FROM g""")
def _values(spark, sf):
    return M.facet_values(points(spark, sf), {"authors": "author_filter", "domains": "domain_filter", "growths": "growth_filter"})


@query("facet_ranges", f"""{_REC}, f AS (SELECT unnest([{{'f': 'edits', 'v': edit_count}}, {{'f': 'refs', 'v': n_references}}, {{'f': 'links', 'v': n_links}}]) AS u FROM k)
SELECT u.f AS facet, min(u.v) AS min, max(u.v) AS max, floor(quantile_cont(u.v, 0.99))::BIGINT AS slider_max FROM f GROUP BY u.f
UNION ALL SELECT 'year', min(edit_year), max(edit_year), max(edit_year) FROM k""")
def _ranges(spark, sf):
    return M.facet_ranges(points(spark, sf))


@query("kw_universe", f"{_REC} SELECT DISTINCT unnest(keywords) AS keyword FROM k")
def _universe(spark, sf):
    return M.keyword_universe(I.records(spark, sf))


@query("map_facets", f"""{_POINTS}, fa_f AS (SELECT DISTINCT unnest([{{'f': 'authors', 'v': author_filter}}, {{'f': 'domains', 'v': domain_filter}}, {{'f': 'types', 'v': type_filter}},
    {{'f': 'growths', 'v': growth_filter}}, {{'f': 'eras', 'v': era_filter}}]) AS u FROM pt),
fa_g AS (SELECT u.f AS facet, u.v AS value, CASE u.v WHEN 'unknown' THEN 1 WHEN 'Unknown' THEN 2 WHEN 'other' THEN 3 WHEN 'Other' THEN 4 ELSE 0 END AS t FROM fa_f),
fa_w AS (SELECT DISTINCT unnest(keywords) AS value FROM k),
fa_r AS (SELECT unnest([{{'f': 'edits', 'v': edit_count}}, {{'f': 'refs', 'v': n_references}}, {{'f': 'links', 'v': n_links}}]) AS u FROM k)
SELECT facet, row_number() OVER (PARTITION BY facet ORDER BY t, value) - 1 AS position, value, NULL::BIGINT AS min, NULL::BIGINT AS max, NULL::BIGINT AS slider_max FROM fa_g
UNION ALL SELECT 'keywords', row_number() OVER (ORDER BY value) - 1, value, NULL, NULL, NULL FROM fa_w WHERE value <> ''
UNION ALL SELECT u.f, NULL, NULL, min(u.v)::BIGINT, max(u.v)::BIGINT, floor(quantile_cont(u.v, 0.99))::BIGINT FROM fa_r GROUP BY u.f
UNION ALL SELECT 'year', NULL, NULL, min(edit_year)::BIGINT, max(edit_year)::BIGINT, max(edit_year)::BIGINT FROM k""")
def _facets(spark, sf):
    return M.facet_table(points(spark, sf), I.records(spark, sf))


# --- neighbours -----------------------------------------------------------------------------------

_KNN = f"""{S.VECTORS},
u AS (SELECT id, list_transform(emb, lambda x: x / sqrt(list_dot_product(emb, emb))) AS emb FROM v),
dd AS (SELECT a.id AS src, b.id AS dst, round(1 - list_dot_product(a.emb, b.emb), 9) AS distance FROM u a JOIN u b ON a.id <> b.id),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY distance, dst) AS rank FROM dd) WHERE rank <= 15)"""


def neighbours(spark, sf):
    return B.knn(I.vectors(spark, sf), 15)


@query("knn_graph", f"WITH {_KNN} SELECT src, dst, rank, round(distance, 6) AS distance FROM nn")
def _knn(spark, sf):
    return neighbours(spark, sf).withColumn("distance", r6("distance"))


@query("fuzzy_graph", f"""WITH RECURSIVE {_KNN},
l AS (SELECT src, list(distance ORDER BY distance) AS ds, coalesce(min(distance) FILTER (distance > 0), 0) AS rho, log2(count(*)) AS target FROM nn GROUP BY src),
s AS (
  SELECT src, ds, rho, target, 0.0::DOUBLE AS lo, -1.0::DOUBLE AS hi, 1.0::DOUBLE AS mid, 0 AS i FROM l
  UNION ALL
  SELECT src, ds, rho, target, CASE WHEN high THEN lo ELSE mid END, CASE WHEN high THEN mid ELSE hi END,
    CASE WHEN high THEN (lo + mid) / 2 WHEN hi < 0 THEN mid * 2 ELSE (mid + hi) / 2 END, i + 1
  FROM (SELECT *, list_sum(list_transform(ds, lambda d: CASE WHEN d <= rho THEN 1.0 ELSE exp(-(d - rho) / mid) END)) > target AS high FROM s) WHERE i < 64
),
w AS (SELECT nn.src, nn.dst, CASE WHEN distance <= rho THEN 1.0 ELSE exp(-(distance - rho) / mid) END AS w FROM nn JOIN s ON s.src = nn.src AND s.i = 64)
SELECT least(src, dst) AS a, greatest(src, dst) AS b, round(CASE WHEN count(*) = 1 THEN sum(w) ELSE sum(w) - min(w) * max(w) END, 4) AS weight
FROM w GROUP BY ALL""")
def _fuzzy(spark, sf):
    return B.fuzzy_graph(neighbours(spark, sf)).withColumn("weight", F.round("weight", 4))


@query("knn_recall")
def _recall(spark, sf):
    """How many of the exact neighbours of every fiftieth id the approximate search finds where it has to cut the rows at least four times, and at what cost."""
    vectors = I.vectors(spark, sf)
    got, how = B.knn_counted(vectors, leaf_rows=max(1, vectors.count() // 24))
    both = neighbours(spark, sf).where("src % 50 = 0").join(got.select("src", "dst", F.lit(1).alias("held")), ["src", "dst"], "left")
    return both.agg(
        F.countDistinct("src").alias("probes"), F.avg(F.coalesce("held", F.lit(0))).alias("recall"), F.lit(how["cuts"]).alias("cuts"),
        F.lit(how["rounds"]).alias("rounds"), F.lit(float(how["per_row"])).alias("comparisons_per_row"))


@query("pca_2d")
def _pca(spark, sf):
    out = B.pca_2d(I.vectors(spark, sf))
    return out.select("id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query("layout_2d")
def _layout(spark, sf):
    return B.layout_2d(B.pca_2d(I.vectors(spark, sf)), B.fuzzy_graph(neighbours(spark, sf)))


@query("layout_recall")
def _layout_recall(spark, sf):
    """The share of the neighbours of the vectors that are neighbours of the positions as well: of the layout, and of the two main axes that it starts from."""
    near = neighbours(spark, sf)
    want = near.select("src", "dst")
    start = settle(B.pca_2d(I.vectors(spark, sf)))
    end = B.layout_2d(start, B.fuzzy_graph(near))

    def share(place):
        near = B.knn(place.select("id", F.array("x", "y").alias("embedding")), metric="euclidean")
        both = want.join(near.select("src", "dst", F.lit(1).alias("held")), ["src", "dst"], "left")
        return both.agg(F.avg(F.coalesce("held", F.lit(0))).alias("recall"))

    named = share(end).withColumn("positions", F.lit("layout_2d")).unionByName(share(start).withColumn("positions", F.lit("pca_2d")))
    return named.select("positions", "recall")


# Connected components of each scale, by the smallest id that can be reached.
_SCALES = ", ".join(str(q) for q in Y.SCALES)
_LIMITS = " UNION ALL ".join(f"SELECT {i} AS scale, round((SELECT quantile_cont(core, {q}) FROM core), 9) AS t" for i, q in enumerate(Y.SCALES))


def _components_sql(knn: str) -> str:
    return f"""WITH RECURSIVE {knn},
core AS (SELECT src, max(distance) AS core FROM nn GROUP BY src),
cut AS (SELECT generate_subscripts([{_SCALES}], 1) - 1 AS scale, unnest([{_SCALES}]) AS q),
lim AS ({_LIMITS}),
mr AS (SELECT nn.src, nn.dst, round(greatest(a.core, b.core, distance), 9) AS w FROM nn JOIN core a ON a.src = nn.src JOIN core b ON b.src = nn.dst),
ed AS (SELECT DISTINCT scale, src, dst FROM (SELECT scale, src, dst FROM mr, lim WHERE w <= t UNION ALL SELECT scale, dst, src FROM mr, lim WHERE w <= t)),
reach AS (SELECT scale, core.src AS id, core.src AS root FROM core, cut
  UNION SELECT r.scale, e.dst, r.root FROM reach r JOIN ed e ON e.scale = r.scale AND e.src = r.id),
comps AS (SELECT id, scale::BIGINT AS scale, min(root) AS component FROM reach GROUP BY id, scale)"""


# Layers from the components: enough clusters of enough rows, and not the clusters of the scale before.
_LAYERS_SQL = """,
sz AS (SELECT scale, component, count(*) AS n FROM comps GROUP BY ALL HAVING count(*) >= 20),
fd AS (SELECT scale, count(*) AS k, sum(n) AS m FROM sz GROUP BY scale),
lg AS (SELECT *, lag(k) OVER (ORDER BY scale) AS pk, lag(m) OVER (ORDER BY scale) AS pm FROM fd),
en AS (SELECT scale FROM lg WHERE k >= 4 AND (k, m) IS DISTINCT FROM (pk, pm)),
kp AS (SELECT scale FROM en UNION SELECT max_by(scale, k * 10 + scale) FROM fd WHERE NOT EXISTS (SELECT 1 FROM en)),
la AS (SELECT scale, row_number() OVER (ORDER BY scale DESC) - 1 AS layer FROM kp),
ci AS (SELECT scale, component, row_number() OVER (PARTITION BY scale ORDER BY n DESC, component) - 1 AS c FROM sz)
SELECT id, layer, coalesce(c, -1) AS cluster_id FROM comps JOIN la USING (scale) LEFT JOIN ci USING (scale, component)"""

@query("density_components", _components_sql(_KNN) + " SELECT * FROM comps")
def _components(spark, sf):
    rows = Y.density_components(neighbours(spark, sf))
    return rows.withColumn("scale", F.col("scale").cast("bigint"))


@query("density_layers_hd", _components_sql(_KNN) + _LAYERS_SQL)
def _layers_hd(spark, sf):
    out = Y.density_layers(neighbours(spark, sf))
    return out.withColumn("layer", F.col("layer").cast("bigint"))


@query("spanning_forest")
def _forest(spark, sf):
    return H.spanning_forest(Y.mutual_reachability(neighbours(spark, sf))).withColumn("weight", F.round("weight", 6))


@query("density_layers")
def _layers(spark, sf):
    """The most stable clusters of the map positions."""
    place = B.pca_2d(I.vectors(spark, sf)).select("id", F.array("x", "y").alias("embedding"))
    return H.stable_layers(B.knn(place, metric="euclidean"))


@query("density_layers_vectors")
def _layers_vectors(spark, sf):
    """The most stable clusters of the vectors themselves."""
    return H.stable_layers(neighbours(spark, sf))


# --- clusters -------------------------------------------------------------------------------------

_LY = f"WITH {S.VECTORS}, {S.LAYERS}"


@query("cluster_tree", f"""{_LY}, o AS (SELECT a.layer, a.cluster_id, b.cluster_id AS parent_id, count(*) AS n FROM ly a JOIN ly b
  ON a.id = b.id AND b.layer = a.layer - 1 WHERE a.cluster_id >= 0 AND b.cluster_id >= 0 GROUP BY ALL)
SELECT layer::BIGINT AS layer, cluster_id::BIGINT AS cluster_id, parent_id::BIGINT AS parent_id, n AS n_shared
FROM (SELECT *, row_number() OVER (PARTITION BY layer, cluster_id ORDER BY n DESC, parent_id) AS rn FROM o) WHERE rn = 1""")
def _tree(spark, sf):
    return Y.cluster_tree(I.layers(spark, sf)).withColumn("layer", F.col("layer").cast("bigint"))


_EXEMPLARS = f"""{_LY}, x AS (SELECT layer, cluster_id, id, generate_subscripts(emb, 1) AS dim, unnest(emb) AS val FROM ly WHERE cluster_id >= 0),
c AS (SELECT layer, cluster_id, dim, avg(val) AS m FROM x GROUP BY ALL),
f AS (SELECT layer, cluster_id, id, round(sqrt(sum((val - m) * (val - m))), 9) AS distance FROM x JOIN c USING (layer, cluster_id, dim) GROUP BY ALL),
ex AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY layer, cluster_id ORDER BY distance, id) AS rank FROM f) WHERE rank <= 3)"""


@query("cluster_exemplars", f"""{_EXEMPLARS} SELECT layer::BIGINT AS layer, cluster_id::BIGINT AS cluster_id, rank, id, round(distance, 6) AS distance FROM ex""")
def _exemplars(spark, sf):
    rows = T.exemplars(I.layers(spark, sf), I.vectors(spark, sf))
    return rows.withColumns({"layer": F.col("layer").cast("bigint"), "distance": r6("distance")})


@query("label_pivot", f"""{_LY} SELECT id, {', '.join(f"max(CASE WHEN layer = {i} THEN CASE WHEN cluster_id < 0 THEN 'Unlabelled' ELSE 'topic ' || cluster_id END END) AS label_layer_{i}" for i in (0, 1))}
FROM ly GROUP BY id""")
def _pivot(spark, sf):
    return T.label_pivot(I.layer_labels(spark, sf), 2)


@query("label_summary", f"""{_LY} SELECT layer::BIGINT AS layer, count(*) AS n_rows, count(DISTINCT cluster_id) AS n_labels,
  count(*) FILTER (cluster_id < 0) AS n_unlabelled, round(100.0 * count(*) FILTER (cluster_id < 0) / count(*), 1) AS pct_unlabelled
FROM ly GROUP BY layer""")
def _label_summary(spark, sf):
    return T.label_summary(I.layer_labels(spark, sf)).withColumn("layer", F.col("layer").cast("bigint"))


@query("top_labels", f"""{_LY}, g AS (SELECT layer, CASE WHEN cluster_id < 0 THEN 'Unlabelled' ELSE 'topic ' || cluster_id END AS label, count(*) AS n FROM ly GROUP BY ALL)
SELECT layer::BIGINT AS layer, label, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY layer ORDER BY n DESC, label) AS rank FROM g) WHERE rank <= 10""")
def _top_labels(spark, sf):
    return T.top_labels(I.layer_labels(spark, sf)).withColumn("layer", F.col("layer").cast("bigint"))


_PHRASES = f"""WITH sl AS (
  SELECT doc_id AS id, text, 0 AS layer, CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END AS cluster_id FROM documents
  UNION ALL SELECT doc_id, text, 1, substr(source, 4)::INT FROM documents),
c AS (SELECT layer, cluster_id, term, count(*) AS n FROM (SELECT layer, cluster_id, unnest({S.WORDS}) AS term FROM sl) GROUP BY ALL),
le AS (SELECT layer, cluster_id, sum(n) AS length FROM c GROUP BY ALL),
us AS (SELECT term, sum(n) AS uses FROM c GROUP BY term),
sc AS (SELECT layer, cluster_id, term, round(n / length * ln(1 + (SELECT avg(length) FROM le) / uses), 9) AS score FROM c JOIN le USING (layer, cluster_id) JOIN us USING (term)),
ph AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY layer, cluster_id ORDER BY score DESC, term) AS rank FROM sc) WHERE rank <= 8),
li AS (SELECT layer, cluster_id, list(term ORDER BY rank) AS terms FROM ph GROUP BY ALL),
tr AS (SELECT *, array_to_string(terms[1:3], ', ') AS short, array_to_string(terms[1:4], ', ') AS long FROM li),
na AS (SELECT layer, cluster_id, CASE WHEN count(*) OVER (PARTITION BY layer, short) = 1 THEN short
  WHEN count(*) OVER (PARTITION BY layer, long) = 1 THEN long ELSE long || ' #' || cluster_id END AS name FROM tr)"""


def phrases(spark, sf):
    return T.keyphrases(I.source_layers(spark, sf), 8, ("layer", "cluster_id"))


@query("cluster_keyphrases", f"{_PHRASES} SELECT layer::BIGINT AS layer, cluster_id::BIGINT AS cluster_id, rank, term, round(score, 6) AS score FROM ph")
def _phrases(spark, sf):
    return phrases(spark, sf).withColumns({"layer": F.col("layer").cast("bigint"), "score": r6("score")})


@query("cluster_names", f"{_PHRASES} SELECT layer::BIGINT AS layer, cluster_id::BIGINT AS cluster_id, name FROM na")
def _names(spark, sf):
    return T.name_clusters(phrases(spark, sf), ("layer", "cluster_id")).withColumn("layer", F.col("layer").cast("bigint"))


@query("layer_report", f"""{_EXEMPLARS}, b AS (SELECT item_id AS id, text FROM benchmark),
tx AS (SELECT v.id, 'vector ' || v.id || ' of label ' || label || repeat(' and more', (v.id % 20)::INT) AS text FROM v),
q AS (SELECT layer, cluster_id, string_agg(CASE WHEN length(text) <= 120 THEN text ELSE left(text, 117) || '...' END, '|' ORDER BY rank) AS exemplars
  FROM ex JOIN tx USING (id) GROUP BY ALL),
g AS (SELECT layer, cluster_id, count(*) AS n_members FROM ly GROUP BY ALL),
z AS (SELECT layer, n_members AS n_noise FROM g WHERE cluster_id < 0)
SELECT layer::BIGINT AS layer, cluster_id::BIGINT AS cluster_id, 'topic ' || cluster_id AS name, n_members, coalesce(n_noise, 0) AS n_noise, exemplars
FROM g JOIN q USING (layer, cluster_id) LEFT JOIN z USING (layer)""")
def _layer_report(spark, sf):
    vectors, layers = I.vectors(spark, sf), I.layers(spark, sf)
    texts = vectors.selectExpr(
        "id", "concat('vector ', id, ' of label ', label, repeat(' and more', cast(id % 20 as int))) AS text")
    names = I.layer_labels(spark, sf).where("cluster_id >= 0").selectExpr("layer", "cluster_id", "label AS name").distinct()
    out = T.layer_report(layers, names, T.exemplars(layers, vectors), texts)
    return out.withColumns({"layer": F.col("layer").cast("bigint"), "exemplars": F.array_join("exemplars", "|")})
