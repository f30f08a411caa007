"""Cross-reference edges, graph reports, splits and adjacency; a graph is an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphatlas.functions.strings import ANY_BREAK, BLANK, let
from glyphatlas.operators.ranking import exact_quantiles
from glyphatlas.session import cut_lineage, settle
from glyphatlas.vocab import HOLDOUT_FRACTION, SPLIT_SEED

_XREF = rf"(?U)^%Y{BLANK}+A\d+(?={BLANK}|$)"
_SOURCE = rf"(?U)^%Y{BLANK}+(A\d+)"
# Fixed value: ids of exactly six digits, so a longer number counts by its first six.
ID_PATTERN = r"A[0-9]{6}"
# Ids of six digits or more, read to their end.
WHOLE_ID_PATTERN = r"A[0-9]{6,}"
_PREFIX_DIGITS = 4
_MOST_SORTED = 100_000


def extract_edges(texts: DataFrame, text_col: str = "text", id_pattern: str = ID_PATTERN) -> DataFrame:
    """(src, dst) for every id in every cross-reference line, without self references.

    The source id is that of the line itself. Ids are found without word boundaries by `id_pattern`: with the
    default a longer number yields its first six digits, with WHOLE_ID_PATTERN all of them.
    """
    found = texts.select(F.explode(_pairs(F.col(text_col), id_pattern)).alias("p"))
    return found.select("p.src", "p.dst")


def _pairs(text: Column, id_pattern: str = ID_PATTERN) -> Column:
    """array<struct<src, dst>> of one text."""
    lines = F.filter(F.split(text, ANY_BREAK), lambda x: x.startswith("%Y") & x.rlike(_XREF))

    def of_line(line: Column) -> Column:
        found = F.regexp_extract_all(F.regexp_replace(line, _SOURCE, ""), F.lit(id_pattern), F.lit(0))
        return let(F.regexp_extract(line, _SOURCE, 1), lambda src: F.transform(
            F.filter(found, lambda d: d != src), lambda d: F.struct(src.alias("src"), d.alias("dst"))))

    return F.flatten(F.transform(lines, of_line))


def edge_cache(texts: DataFrame, id_pattern: str = ID_PATTERN) -> DataFrame:
    """Per file: version columns and its (src, dst) pairs, kept so that unchanged files are not read again."""
    return texts.select(F.col("path").alias("path_rel"), "mtime", "size", _pairs(F.col("text"), id_pattern).alias("pairs"))


def cached_edges(cache: DataFrame) -> DataFrame:
    return cache.select(F.explode("pairs").alias("p")).select("p.src", "p.dst")


def canonical(edges: DataFrame) -> DataFrame:
    """Distinct undirected edges (from_id <= to_id)."""
    return edges.select(F.least("src", "dst").alias("from_id"), F.greatest("src", "dst").alias("to_id")).distinct()


def symmetric(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, in one scan of the input."""
    both = F.explode(F.array(F.struct(F.col("from_id").alias("src"), F.col("to_id").alias("dst")),
                             F.struct(F.col("to_id").alias("src"), F.col("from_id").alias("dst"))))
    return edges.select(both.alias("e"), *[c for c in edges.columns if c not in ("from_id", "to_id")]).select("e.*", *[
        c for c in edges.columns if c not in ("from_id", "to_id")])


def touched_nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("from_id", "to_id")).alias("id")).distinct()


def in_scope(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among `nodes`; Spark broadcasts the ids only if they are small."""
    ids = nodes.select("id")
    return edges.join(ids.withColumnRenamed("id", "from_id"), "from_id", "left_semi").join(
        ids.withColumnRenamed("id", "to_id"), "to_id", "left_semi").select(*edges.columns)


def edge_report(edges: DataFrame) -> DataFrame:
    """One row: edges, touched nodes, and median, 95th percentile and maximum of edges per first node. The edges are worked out once."""
    edges = settle(edges.select("from_id", "to_id"))
    fan = settle(edges.groupBy("from_id").agg(F.count(F.lit(1)).alias("n")))
    spread = exact_quantiles(fan, "n", {"fan_median": 0.5, "fan_p95": 0.95})
    return fan.agg(
        F.sum("n").alias("n_edges"),
        F.lit(touched_nodes(edges).agg(F.count(F.lit(1))).scalar()).alias("n_nodes"),
        F.lit(spread.select("fan_median").scalar()).alias("fan_median"),
        F.lit(spread.select("fan_p95").scalar()).alias("fan_p95"),
        F.max("n").alias("fan_max"),
    )


def split_edges(edges: DataFrame, fraction: float = HOLDOUT_FRACTION, seed: int = SPLIT_SEED) -> DataFrame:
    """Add `split`: the first max(1, round(fraction * E)) edges in digest order are the holdout.

    Digests are uniform, so nothing is sorted: edges are counted per digest prefix, longer ones within the prefix that
    holds the last holdout digest until at most _MOST_SORTED edges share it, and every edge is compared with that digest.
    """
    name = F.concat_ws("-", F.col("from_id").cast("string"), F.col("to_id").cast("string"))
    keyed = cut_lineage(edges.withColumn("_key", name).withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), "_key"))))
    # one prefix after the other gets longer, until few enough edges share it to be sorted
    near, digits, skipped, hold = keyed, 0, 0, None
    while True:
        digits += _PREFIX_DIGITS
        prefix = F.substring("_h", 1, digits)
        counts = near.groupBy(prefix.alias("_p")).agg(F.count(F.lit(1)).alias("n"))  # at most 16 ** _PREFIX_DIGITS rows
        order = W.orderBy("_p").rowsBetween(W.unboundedPreceding, W.currentRow)
        counts = counts.select("_p", "n", F.sum("n").over(order).alias("upto"))
        if hold is None:
            hold = max(1, round(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * fraction))
        cut = counts.where(F.col("upto") >= hold - skipped).orderBy("_p").first()
        if cut is None:
            return edges.withColumn("split", F.lit("train"))
        skipped += cut["upto"] - cut["n"]
        near = near.where(prefix == cut["_p"]).select("_h", "_key")
        if cut["n"] <= _MOST_SORTED or digits >= 32:
            break
    last = near.orderBy("_h", "_key").offset(hold - skipped - 1).limit(1).first()
    held = (F.col("_h") < last["_h"]) | ((F.col("_h") == last["_h"]) & (F.col("_key") <= last["_key"]))
    return keyed.select(*edges.columns, F.when(held, "holdout").otherwise("train").alias("split"))


def adjacency(edges: DataFrame) -> DataFrame:
    """(src, dst, weight): both directions, repeats add up, the weights of a source sum to 1."""
    pairs = symmetric(edges.select("from_id", "to_id")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    total = pairs.groupBy("src").agg(F.sum("n").alias("deg"))
    return pairs.join(total, "src").select("src", "dst", (F.col("n") / F.col("deg")).alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree): number of distinct neighbours."""
    return symmetric(edges.select("from_id", "to_id")).distinct().groupBy(F.col("src").alias("id")).agg(
        F.count(F.lit(1)).alias("degree"))


def isolated(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return nodes.select("id").join(touched_nodes(edges), "id", "left_anti")


def eval_pairs(split: DataFrame) -> DataFrame:
    """Both directions of the holdout edges whose two ends keep at least one training edge, as (src, dst)."""
    train = touched_nodes(split.where("split = 'train'"))
    hold = split.where("split = 'holdout'").select("from_id", "to_id")
    return symmetric(in_scope(hold, train))
