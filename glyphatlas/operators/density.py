"""Hierarchical density clustering over a nearest-neighbour graph.

Two points join a cluster at scale t if a chain of mutual-reachability edges of at most t connects them,
where the edge weight is the largest of both core distances and the distance itself. The scales are
quantiles of the core distance. Scales are processed from fine to coarse on the contracted graph, so each
layer costs only what the finer layers left over, and layers nest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphatlas.operators.components import contract, relabel
from glyphatlas.operators.ranking import exact_quantiles, running_totals
from glyphatlas.session import cut_lineage
from glyphatlas.vocab import NOISE

SCALES = (0.25, 0.5, 0.75, 0.9, 0.97)


def mutual_reachability(neighbours: DataFrame) -> DataFrame:
    """(a, b, weight): undirected edges of the neighbour lists (src, dst, distance)."""
    core = neighbours.groupBy("src").agg(F.max("distance").alias("core"))
    ca = core.select("src", F.col("core").alias("core_a"))
    cb = core.select(F.col("src").alias("dst"), F.col("core").alias("core_b"))
    weighted = neighbours.join(ca, "src").join(cb, "dst").select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"),
        F.greatest("core_a", "core_b", "distance").alias("weight"))
    return weighted.groupBy("a", "b").agg(F.min("weight").alias("weight"))


def density_components(neighbours: DataFrame, scales=SCALES) -> DataFrame:
    """(id, scale, component) for every point and scale index; 0 is the finest scale."""
    lists = cut_lineage(neighbours.select("src", "dst", "distance"))
    core = lists.groupBy("src").agg(F.max("distance").alias("core"))
    cuts = exact_quantiles(core, "core", {f"s{i}": q for i, q in enumerate(scales)}).first()
    points = cut_lineage(lists.select(F.col("src").alias("id")).distinct().withColumn("component", F.col("id")))
    live = cut_lineage(mutual_reachability(lists))
    layers = None
    for i in range(len(scales)):
        # compare after rounding: a quantile may be one of the weights
        close = F.round("weight", 9) <= F.round(F.lit(cuts[f"s{i}"]), 9)
        roots = contract(live.where(close).select("a", "b"))
        step = roots.select(F.col("node").alias("component"), F.col("root"))
        points = cut_lineage(
            points.join(step, "component", "left").select("id", F.coalesce("root", "component").alias("component")))
        live = cut_lineage(relabel(live.where(~close), roots))
        layer = points.select("id", F.lit(i).alias("scale"), "component")
        layers = layer if layers is None else layers.unionByName(layer)
    return layers


def density_layers(
    neighbours: DataFrame, min_size: int = 20, min_clusters: int = 4, max_layers: int = 5, scales=SCALES
) -> DataFrame:
    """(id, layer, cluster_id): nested clusters, layer 0 the coarsest; -1 marks noise.

    Components below `min_size` are noise. Scales that leave fewer than `min_clusters` clusters, or repeat
    the clusters of a finer scale, give no layer; if no scale has enough clusters the one with most is kept.
    """
    parts = cut_lineage(density_components(neighbours, scales))
    sizes = parts.groupBy("scale", "component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_size)
    sizes = cut_lineage(sizes)
    # one row per scale
    found = {r["scale"]: (r["k"], r["m"]) for r in sizes.groupBy("scale").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("m")).collect()}
    kept, last = [], None
    for scale in sorted(found):
        if found[scale][0] >= min_clusters and found[scale] != last:
            kept.append(scale)
        last = found[scale]
    if not kept and found:
        kept = [max(found, key=lambda s: (found[s][0], s))]
    kept = kept[-max_layers:]
    if not kept:
        return parts.select("id", F.lit(0).alias("layer"), F.lit(NOISE).cast("bigint").alias("cluster_id")).distinct()
    layer = F.create_map(*[F.lit(x) for i, s in enumerate(reversed(kept)) for x in (s, i)])
    chosen = sizes.where(F.col("scale").isin(*kept)).select(layer[F.col("scale")].alias("layer"), "scale", "component", "n")
    placed = running_totals(chosen, [F.col("layer"), F.col("n").desc(), F.col("component")], {"place": F.lit(1).cast("bigint")})
    placed = cut_lineage(placed)
    first = placed.groupBy("layer").agg(F.min("place").alias("start"))
    ids = placed.join(first, "layer").select("scale", "component", (F.col("place") - F.col("start")).alias("cluster_id"))
    rows = parts.where(F.col("scale").isin(*kept)).join(ids, ["scale", "component"], "left")
    return rows.select("id", layer[F.col("scale")].alias("layer"), F.coalesce("cluster_id", F.lit(NOISE)).alias("cluster_id"))


def cluster_tree(layers: DataFrame) -> DataFrame:
    """(layer, cluster_id, parent_id): each cluster's largest overlap in the next coarser layer."""
    real = layers.where(F.col("cluster_id") != NOISE)
    up = real.select("id", (F.col("layer") + 1).alias("layer"), F.col("cluster_id").alias("parent_id"))
    shared = real.join(up, ["id", "layer"]).groupBy("layer", "cluster_id", "parent_id").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct("n", (-F.col("parent_id")).alias("neg"))).alias("best")
    return shared.groupBy("layer", "cluster_id").agg(best).select(
        "layer", "cluster_id", (-F.col("best.neg")).alias("parent_id"), F.col("best.n").alias("n_shared"))


__all__ = ["SCALES", "cluster_tree", "density_components", "density_layers", "mutual_reachability"]
