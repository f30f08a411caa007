"""Whole jobs: each reads tables, plans one or a few Spark queries, and publishes verified snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphatlas.functions import compose as C
from glyphatlas.operators import agreement as A
from glyphatlas.operators import graph as G
from glyphatlas.operators import hierarchy as H
from glyphatlas.operators import incremental as N
from glyphatlas.operators import inference as I
from glyphatlas.operators import mapdata as M
from glyphatlas.operators import naming as T
from glyphatlas.operators import neighbors as B
from glyphatlas.operators import selection as L
from glyphatlas.operators import smoothing as S
from glyphatlas.operators import vectors as V
from glyphatlas.operators.postings import write_postings
from glyphatlas.operators.records import parse_report, tagged_records
from glyphatlas.session import cut_lineage, settle
from glyphatlas.sources.exports import write_csv, write_json
from glyphatlas.sources.snapshots import exists, get_or_build, merge_snapshot, publish_snapshot, read_snapshot, sample_path
from glyphatlas.sources.tagged import discover, scan_tagged
from glyphatlas.vocab import (
    ALPHA_GRID,
    CONTENT_KEYWORDS,
    CURATED_TARGET,
    EMBED_TEXT_VERSION,
    ENUM_FIELDS,
    N_ITER_GRID,
    VARIANTS,
)


def _changed_files(spark: SparkSession, root: str, table: str, glob: str) -> tuple[DataFrame | None, DataFrame | None]:
    """((path, mtime, size) of new and changed files, path_rel of vanished ones); both None where there is no table yet."""
    if not exists(spark, table):
        return None, None
    found = settle(discover(spark, root, glob))
    cache = read_snapshot(spark, table).select("path_rel", "mtime", "size")
    gone = cache.select("path_rel").join(found.select(F.col("path").alias("path_rel")), "path_rel", "left_anti")
    return settle(N.changed(found, cache.withColumnRenamed("path_rel", "path"))), gone


def ingest(spark: SparkSession, root: str, table: str, quarantine: str | None = None, glob: str = "*.seq") -> DataFrame:
    """Bring the record table up to date with the files below `root`; returns the parse report.

    Only the buckets of changed files are rewritten. Rows of vanished files go, also when nothing else changed. Files that are not UTF-8 are listed in
    `quarantine` (beside the table if not given); their old rows stay and they are tried again next time.
    """
    wanted, gone = _changed_files(spark, root, table, glob)
    read = scan_tagged(spark, root, glob, wanted)
    merge_snapshot(tagged_records(read.where("valid").drop("valid")), table, "path_rel", gone)
    _set_aside(read, quarantine or f"{table}._quarantine")
    return parse_report(read_snapshot(spark, table))


def _set_aside(read: DataFrame, quarantine: str) -> None:
    """List the files of this run that are not UTF-8; their bytes are read again for that, not kept."""
    publish_snapshot(read.where("NOT valid").select("path", "mtime", "size"), quarantine)


def extract_references(
    spark: SparkSession, root: str, cache: str, edges: str, glob: str = "*.seq", quarantine: str | None = None, id_pattern: str = G.ID_PATTERN,
) -> DataFrame:
    """Bring the per-file edge cache up to date, in the buckets of changed files, and rebuild the undirected edge table; returns its report. Files
    that are not UTF-8 are listed in `quarantine`, beside the cache if not given."""
    wanted, gone = _changed_files(spark, root, cache, glob)
    read = scan_tagged(spark, root, glob, wanted)
    merge_snapshot(G.edge_cache(read.where("valid"), id_pattern), cache, "path_rel", gone)
    _set_aside(read, quarantine or f"{cache}._quarantine")
    publish_snapshot(G.canonical(G.cached_edges(read_snapshot(spark, cache))), edges)
    return G.edge_report(read_snapshot(spark, edges))


def select_records(spark: SparkSession, table: str, out: str, scope: str, target: int = CURATED_TARGET) -> DataFrame:
    """Publish the records of a scope, best first; returns the audit of exclusions."""
    records = read_snapshot(spark, table)
    publish_snapshot(L.select(records, scope, target).orderBy(*L.score_order()), out)
    return L.exclude_audit(records)


def draw_sample(spark: SparkSession, table: str, root: str, n: int, seed: int) -> DataFrame:
    """The evaluation sample for (n, seed): read again if it exists, else drawn and published."""
    path = sample_path(root, n, seed)
    return get_or_build(spark, path, lambda: L.sample_n(read_snapshot(spark, table), n, seed))


def enrich(
    spark: SparkSession, table: str, out: str, classifier: I.Classifier | None = None, skip: bool = False,
    columns: tuple[str, ...] = ("name", "offset", "values_preview_str", "keywords", "comments", "formulas", "author", "last_edited"),
    chunks: int = 1, answers: str | None = None, version: str = "1",
) -> DataFrame:
    """Classify records and publish them with the enum fields; returns completeness, with the rows whose last call failed.

    With `skip` the input passes through. Without a classifier the built-in rules answer. Answers are appended to `answers` in
    `chunks`, so that an interrupted run loses at most one chunk, each with the classifier's `version` and a digest of the columns it
    saw: a row is sent again if it was edited, if the version is another, or if it has no complete answer yet.
    """
    records = read_snapshot(spark, table)
    if skip:
        publish_snapshot(records, out)
        return records.agg(F.count(F.lit(1)).alias("n_rows"))
    failed = F.lit(0).cast("bigint")
    if classifier is None:
        done = I.classify_by_rules(records)
    else:
        answers = answers or f"{out}._answers"
        seen = I.text_hash(*[F.col(c) for c in columns]).alias("row_hash")
        frame = _with_fields(records)
        marks = cut_lineage(frame.select("id", seen))
        if exists(spark, answers):
            frame = N.reuse_complete(frame, _best_answers(_current_answers(spark.read.parquet(answers), marks, version)), ENUM_FIELDS)
        frame = cut_lineage(frame)
        todo = N.needs_work(frame, ENUM_FIELDS)
        for c in range(chunks):
            part = todo.where(F.pmod(F.xxhash64("id"), F.lit(chunks)) == c)
            got = I.classify(part, classifier, columns).withColumns({"classifier_version": F.lit(version), "answered_at": F.current_timestamp()})
            got.join(marks, "id").write.mode("append").parquet(answers)
        current = cut_lineage(_current_answers(spark.read.parquet(answers), marks, version))
        done = N.reuse_complete(frame, _best_answers(current), ENUM_FIELDS)
        last = current.groupBy("id").agg(F.max_by("error", "answered_at").alias("error"))
        failed = F.lit(last.where("error IS NOT NULL").count()).cast("bigint")
    publish_snapshot(done, out)
    return A.completeness(read_snapshot(spark, out).withColumn("run", F.lit("enrich")), "run").withColumn("n_failed", failed)


def _with_fields(df: DataFrame) -> DataFrame:
    return df.withColumns({f: F.lit(None).cast("string") for f in ENUM_FIELDS if f not in df.columns})


def _current_answers(answers: DataFrame, marks: DataFrame, version: str) -> DataFrame:
    """Answers of this version to rows as they are now."""
    return answers.where(F.col("classifier_version") == version).join(marks, ["id", "row_hash"], "left_semi")


def _best_answers(answers: DataFrame) -> DataFrame:
    """The latest complete answer per id, for ids that have one."""
    full = answers.dropna(subset=list(ENUM_FIELDS))
    return full.groupBy("id").agg(F.max_by(F.struct(*ENUM_FIELDS), "answered_at").alias("a")).select("id", "a.*")


def embed_records(
    spark: SparkSession, table: str, out: str, embedder: I.Embedder | None = None, version: str = EMBED_TEXT_VERSION,
    dim: int = 256,
) -> int:
    """Embed records that have no vector of this version and text, and publish vectors for exactly the
    current ids; returns their number."""
    texts = read_snapshot(spark, table).select("id", C.embed_text().alias("text"))
    if embedder is None:
        return publish_snapshot(I.hash_embed(texts, dim, version), out)
    if not exists(spark, out):
        return publish_snapshot(I.embed(texts, embedder, version), out)
    old = read_snapshot(spark, out)
    current = old.join(texts.select("id", I.text_hash(F.col("text")).alias("text_hash")), ["id", "text_hash"], "left_semi")
    current = current.select(*old.columns).where(F.coalesce("text_version", F.lit("v1")) == version)
    new = I.embed(N.pending(texts, current), embedder, version)
    return publish_snapshot(N.restitch(texts, current, new.select(*old.columns)), out)


def smooth(
    spark: SparkSession, records: str, vectors: str, edges: str, out: str, alphas=ALPHA_GRID, n_iters=N_ITER_GRID,
) -> DataFrame:
    """Split the in-scope edges, search the grid, publish `out`/{split, vectors}, and as JSON `out`/metrics, the cohesion of every class
    in `out`/classes, and counts with the winner in `out`/report; returns the grid. An error if no edge is in scope, none can be evaluated, or the result is not unit."""
    rows = read_snapshot(spark, records).select("id", "keywords")
    points = read_snapshot(spark, vectors).select("id", "embedding")
    inside = G.in_scope(read_snapshot(spark, edges), rows)
    if inside.isEmpty():
        raise ValueError("no edge has both ends in scope")
    publish_snapshot(G.split_edges(inside), f"{out}/split")
    split = read_snapshot(spark, f"{out}/split")
    if G.eval_pairs(split).isEmpty():
        raise ValueError("no holdout edge can be evaluated")
    members = V.class_members(rows, "keywords", CONTENT_KEYWORDS)
    grid, classes, counts = S.grid_report(points, split, members, alphas, n_iters)
    best = S.winner(grid).first()
    links = G.adjacency(split.where("split = 'train'").select("from_id", "to_id"))
    publish_snapshot(S.retrofit(points, links, best["alpha"], best["n_iter"]), f"{out}/vectors")
    check = V.vector_invariants(read_snapshot(spark, f"{out}/vectors")).first()
    if check["n_nan"] or check["n_not_unit"] or check["n_dims"] != 1:
        raise ValueError(f"smoothed vectors break their invariants: {check.asDict()}")
    write_json(grid, f"{out}/metrics")
    write_json(classes, f"{out}/classes")
    write_json(counts.select("*", F.lit(best["alpha"]).alias("alpha"), F.lit(best["n_iter"]).alias("n_iter")), f"{out}/report")
    return grid


def place_and_label(
    spark: SparkSession, records: str, vectors: str, out: str, epochs: int = 30, min_size: int = 20, min_clusters: int = 4,
    flat: bool = True, namer: Callable | None = None, exact: bool = False,
) -> DataFrame:
    """Lay the vectors out in two dimensions, cluster, name, and publish `out`/{coords, labels}; returns the
    label summary. With `flat` the positions are clustered, else the vectors themselves. The neighbours of
    the vectors come from the approximate search, whose work is linear, unless `exact` is asked for."""
    points = read_snapshot(spark, vectors).select("id", "embedding")
    near = settle(B.knn(points) if exact else B.knn_approximate(points))
    place = B.layout_2d(B.pca_2d(points), B.fuzzy_graph(near), epochs)
    publish_snapshot(place, f"{out}/coords")
    coords = read_snapshot(spark, f"{out}/coords")
    if flat:
        near = (B.knn if exact else B.knn_approximate)(coords.select("id", F.array("x", "y").alias("embedding")), metric="euclidean")
    layers = settle(H.stable_layers(near, min_size, min_clusters))
    docs = read_snapshot(spark, records).select("id", C.topic_doc().alias("text"))
    texts = layers.where("cluster_id >= 0").join(docs, "id")
    names = T.name_clusters(T.keyphrases(texts, by=("layer", "cluster_id")), ("layer", "cluster_id"), namer)
    publish_snapshot(T.label_points(layers, names), f"{out}/labels")
    return T.label_summary(read_snapshot(spark, f"{out}/labels"))


def map_tables(spark: SparkSession, records: str, placed: str, out: str) -> DataFrame:
    """Publish the map points and the facet configuration; returns the configuration."""
    rows = read_snapshot(spark, records)
    labels = read_snapshot(spark, f"{placed}/labels")
    n_layers = (labels.agg(F.max("layer")).first()[0] or 0) + 1
    wide = T.label_pivot(labels, n_layers)
    publish_snapshot(M.map_points(rows, read_snapshot(spark, f"{placed}/coords"), wide), f"{out}/points")
    config = M.facets(read_snapshot(spark, f"{out}/points"), rows)
    write_json(config, f"{out}/facets")
    return config


def index_map(spark: SparkSession, tables: str, out: str) -> None:
    """Index the search texts of published map points below `out`; `operators.postings.search_postings` reads it."""
    write_postings(read_snapshot(spark, f"{tables}/points"), out, "id", "search_text")


def compare_annotators(a: DataFrame, b: DataFrame, out: str | None = None) -> dict[str, DataFrame]:
    """All agreement tables of two annotators; the disagreements also go to `out` as CSV."""
    joined = A.join_annotators(a, b)
    differing = A.disagreements(joined)
    if out:
        write_csv(differing, out)
    return {
        "agreement": A.agreement(joined),
        "distribution": A.distribution(joined),
        "confusion": A.confusion(joined),
        "disagreements": differing,
        "top_disagreements": A.top_disagreements(joined),
        "histogram": A.disagree_hist(joined),
    }


def compare_variants(
    spark: SparkSession, records: str, vectors: str, split: str, out: str, variants=VARIANTS, epochs: int = 30, **kw
) -> DataFrame:
    """Smooth, lay out and label every named variant that has not been materialised yet; returns the label
    summaries of all of them, one `variant` column apart."""
    points, edges = read_snapshot(spark, vectors), read_snapshot(spark, split)
    summary = None
    for name, alpha, n_iter in variants:
        base = f"{out}/{name}"
        made = lambda a=alpha, n=n_iter, v=name: S.variant_vectors(points, edges, ((v, a, n),)).select("id", "embedding")
        get_or_build(spark, f"{base}/vectors", made)
        if exists(spark, f"{base}/labels"):
            report = T.label_summary(read_snapshot(spark, f"{base}/labels"))
        else:
            report = place_and_label(spark, records, f"{base}/vectors", base, epochs, **kw)
        report = report.withColumn("variant", F.lit(name))
        summary = report if summary is None else summary.unionByName(report)
    return summary
