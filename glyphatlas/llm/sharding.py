"""Hierarchical weighted hash tree: region, rack and shard are drawn level by level, with Spark functions only.

Every child of a node gets a draw from the document's key and the child's own name, an exponential variate
divided by the child's weight; the smallest wins. So a child wins in proportion to its weight, and a changed
weight changes this child's draws only: rows move into a child that grew or out of one that shrank, within the
subtree above it, and never between two other children. The weight of an inner node is the sum below it.

Law: `key`. doc_id and the tree alone decide. A further shard comes as a region of its own, so that all rows that
move, move into it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphatlas.operators.ranking import with_position
from glyphatlas.session import cut_lineage


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


# Eight equal shards in two regions of two racks.
TREE = tuple(Leaf(f"r{s // 4}", f"k{s // 2}", s) for s in range(8))


def grown(tree: tuple[Leaf, ...], weight: float = 1.0) -> tuple[Leaf, ...]:
    """The tree with one more shard, in a region of its own."""
    shard = max(leaf.shard for leaf in tree) + 1
    return (*tree, Leaf(f"r+{shard}", f"k+{shard}", shard, weight))


def _draw(key: Column, name: str, weight: float) -> Column:
    digest = F.conv(F.substring(F.md5(F.concat(key, F.lit("/" + name)).cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.log((digest + 0.5) / float(1 << 52)) / F.lit(float(weight))


def _level(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """The value of the child with the smallest draw; with one child, its value."""
    if len(children) == 1:
        return children[0][2]
    best = F.array_min(F.array(*[F.struct(_draw(key, name, w).alias("draw"), value.alias("value")) for name, w, value in children]))
    return best["value"]


def shard_of(key: Column, tree: tuple[Leaf, ...]) -> Column:
    """The shard of a key (text). A leaf of weight 0 or less takes nothing."""
    live = [leaf for leaf in tree if leaf.weight > 0]
    if not live:
        raise ValueError("no shard has a weight")
    total = lambda leaves: sum(x.weight for x in leaves)
    names = lambda leaves, part: list(dict.fromkeys(getattr(x, part) for x in leaves))

    def rack(region: str, name: str) -> Column:
        leaves = [x for x in live if (x.region, x.rack) == (region, name)]
        return _level(key, [(f"shard/{x.shard}", x.weight, F.lit(x.shard)) for x in leaves])

    def region(name: str) -> Column:
        leaves = [x for x in live if x.region == name]
        racks = names(leaves, "rack")
        drawn = _level(key, [(f"rack/{name}/{r}", total([x for x in leaves if x.rack == r]), F.lit(r)) for r in racks])
        return _chosen(drawn, racks, lambda r: rack(name, r))

    regions = names(live, "region")
    drawn = _level(key, [(f"region/{r}", total([x for x in live if x.region == r]), F.lit(r)) for r in regions])
    return _chosen(drawn, regions, region)


def _chosen(drawn: Column, names: list[str], below) -> Column:
    if len(names) == 1:
        return below(names[0])
    out = F.when(drawn == names[0], below(names[0]))
    for name in names[1:]:
        out = out.when(drawn == name, below(name))
    return out


def place(docs: DataFrame, tree: tuple[Leaf, ...] = TREE) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of `docs`.

    size: bytes of the text and 1; a null text is empty. A null doc_id is a key of its own. Rows with equal doc_id
    share a shard and get slots beside each other. slot: place within the shard in ascending doc_id order,
    from 0 without gaps. Only narrow rows are dealt out; the texts are read once and not moved. An empty
    table gives no rows.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(key, tree).cast("int").alias("shard"), shard_of(key, grown(tree)).cast("int").alias("grown_shard"))
    placed = cut_lineage(with_position(narrow, [F.col("shard"), F.col("doc_id"), F.col("size"), F.col("text_crc32")], "place"))
    begins = placed.groupBy("shard").agg(F.min("place").alias("begin"))  # one row per shard
    return placed.join(F.broadcast(begins), "shard").select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("place") - F.col("begin")).alias("slot"), "grown_shard")


def place_documents(docs: DataFrame, tree: tuple[Leaf, ...] = TREE) -> DataFrame:
    """The rows of `docs` with their columns, and shard_size, shard and slot of each. Rows that share doc_id and text are alike, so either
    may take either slot."""
    same = W.partitionBy("doc_id", "text_crc32", "size")
    placed = place(docs, tree).select("doc_id", "text_crc32", "size", "shard", "slot", F.row_number().over(same.orderBy("slot")).alias("copy"))
    placed = placed.withColumnsRenamed({c: f"__r_{c}" for c in placed.columns})
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    named = docs.withColumns({
        "__doc_id": F.col("doc_id").cast("long"), "__text_crc32": F.crc32(raw), "__size": (F.octet_length(raw) + 1).cast("long")})
    named = named.withColumn("__copy", F.row_number().over(W.partitionBy("__doc_id", "__text_crc32", "__size").orderBy("text")))
    test = F.lit(True)
    for c in ("doc_id", "text_crc32", "size", "copy"):
        test = test & F.col(f"__{c}").eqNullSafe(F.col(f"__r_{c}"))
    taken = {"shard_size": "__r_size", "shard": "__r_shard", "slot": "__r_slot"}
    own = [F.col(f"`{c}`") for c in docs.columns if c not in taken]
    return named.join(placed, test).select(*own, *[F.col(c).alias(name) for name, c in taken.items()])
