"""Low-discrepancy source schedule: golden-ratio points through cumulative target weights.

1. `targets`: sources weigh by turns 3, 1, 2 in code point order (null last) and share a budget; a target stops at
   `most` times its source's size, and the excess is shared again by weight.
2. `schedule`: slot i stands at a golden-ratio point, the source whose stretch of the cumulative targets holds
   it fills the slot, and slots are ranked per source. Every prefix of the schedule keeps to the target shares up to a
   few slots. Slots beyond a source's target are left out, and the few that the points fall short by come last.
3. `blocks`: each source's documents, shuffled by a digest, form a stream of words that is cut into equal blocks
   and read up to `most` times.
4. `mix` joins slot and block by (source, rank): pieces of documents in the order of the schedule.

Ties in the digest go by doc_id, then size, so reruns agree. Nulls: a null text has no words, a null source is a source of its own, a
null doc_id is shuffled like any other. Sources without words get nothing. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphatlas.llm.common import WORD, null_safe_join
from glyphatlas.operators.ranking import running_totals, with_position
from glyphatlas.session import cut_lineage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 512
# Slots stand at i * STEP modulo PERIOD: STEP is PERIOD over the golden ratio.
PERIOD = 1 << 31
STEP = 1327217885
CELLS = 1 << 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, mark) with a digest to shuffle by."""
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))
    return out.withColumn("mark", F.md5(F.concat(F.lit("mix/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")))


def targets(sizes: DataFrame, share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target): one row per source.

    The level L with sum(min(most * size, L * weight)) = share * total: sources that are full are told apart by one
    aggregate each round, and every round but the last adds to them.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = cut_lineage(with_position(per, [F.col("source").asc_nulls_last()], "turn"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "source_size", weight.alias("weight"))
    cap = F.col("source_size") * most
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, n_full = 0.0, -1
    while True:
        full = cap <= F.lit(level) * F.col("weight")
        seen = ranked.agg(F.count(F.when(full, 1)), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if seen[0] == n_full or not seen[2]:
            break
        n_full = seen[0]
        level = (share * total - (seen[1] or 0)) / seen[2]
    target = F.when(cap <= F.lit(level) * F.col("weight"), cap.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def schedule(wanted: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source, rank): which source fills a slot, and with which of its blocks."""
    spark = wanted.sparkSession
    quota = wanted.select("source", F.ceil(F.floor(F.col("target") + 0.5) / block).cast("long").alias("quota")).where("quota > 0")
    laid = cut_lineage(running_totals(quota, [F.col("source").asc_nulls_last()], {"before": F.col("quota")}))
    total = laid.agg(F.sum("quota")).first()[0] or 0
    # each source with its stretch of the period, once for every cell that the stretch touches
    begin = (F.col("before").cast("double") * PERIOD / max(total, 1)).cast("long")
    end = ((F.col("before") + F.col("quota")).cast("double") * PERIOD / max(total, 1)).cast("long")
    width = PERIOD // CELLS
    stretch = laid.select("source", "quota", begin.alias("begin"), end.alias("end")).where("end > begin")
    stretch = stretch.withColumn("cell", F.explode(F.sequence((F.col("begin") / width).cast("long"), ((F.col("end") - 1) / width).cast("long"))))
    points = spark.range(total).select(F.col("id").alias("slot"), (F.col("id") % PERIOD * STEP % PERIOD).alias("point"))
    points = points.withColumn("cell", (F.col("point") / width).cast("long"))
    hits = points.join(stretch, "cell").where("point >= begin AND point < end").select("slot", "source", "quota")
    placed = cut_lineage(with_position(hits, [F.col("source").asc_nulls_last(), F.col("slot")], "place"))
    first = placed.groupBy("source").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("filled"))
    main = null_safe_join(placed, first, ["source"]).select(
        "slot", "source", (F.col("place") - F.col("first")).alias("rank"), "quota").where("rank < quota")
    short = null_safe_join(laid, first, ["source"], "left").select(
        "source", "quota", F.coalesce("filled", F.lit(0).cast("long")).alias("filled")).where("filled < quota")
    last = short.select("source", F.explode(F.sequence("filled", F.col("quota") - 1)).alias("rank"))
    last = with_position(last, [F.col("rank"), F.col("source").asc_nulls_last()], "at")
    return main.select("slot", "source", "rank").unionByName(last.select((F.col("at") + total).alias("slot"), "source", "rank"))


def blocks(sizes: DataFrame, wanted: DataFrame, block: int = BLOCK, most: int = MOST) -> DataFrame:
    """(source, rank, doc_id, size, row, reading, from_word, to_word): the pieces of each source's shuffled stream, read `most` times,
    that fall into each equal block; the last block ends with the target. Only documents with words have pieces."""
    order = [F.col("source").asc_nulls_last(), F.col("mark"), F.col("doc_id"), F.col("size")]
    laid = running_totals(sizes.where("size > 0"), order, {"before": F.col("size"), "row": F.lit(1).cast("long")})
    ahead = running_totals(wanted, [F.col("source").asc_nulls_last()], {"ahead": F.col("source_size")})
    at = null_safe_join(laid, ahead, ["source"])
    reading = at.withColumn("reading", F.explode(F.array(*[F.lit(i).cast("long") for i in range(most)])))
    begin = F.col("before") - F.col("ahead") + F.col("reading") * F.col("source_size")
    reading = reading.select("source", "doc_id", "size", "row", "reading", begin.alias("begin"), F.floor(F.col("target") + 0.5).alias("stop"))
    reading = reading.where("begin < stop")
    last = (F.least(F.col("begin") + F.col("size"), F.col("stop")) - 1) / block
    cut = reading.withColumn("rank", F.explode(F.sequence((F.col("begin") / block).cast("long"), last.cast("long"))))
    return cut.select(
        "source", "rank", "doc_id", "size", "row", "reading", (F.greatest(F.col("rank") * block, F.col("begin")) - F.col("begin")).alias("from_word"),
        (F.least((F.col("rank") + 1) * block, F.col("begin") + F.col("size"), F.col("stop")) - F.col("begin")).alias("to_word"))


def mix(docs: DataFrame, block: int = BLOCK, share: float = SHARE, most: int = MOST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pieces (slot, source, rank, doc_id, size, row, reading, from_word, to_word), the sized documents and the targets."""
    sizes = cut_lineage(sized(docs))
    wanted = cut_lineage(targets(sizes, share, most))
    slots = schedule(wanted, block)
    pieces = blocks(sizes, wanted, block, most)
    joined = null_safe_join(pieces, slots, ["source", "rank"])
    return joined, sizes, wanted


def taken(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row. Rows that share doc_id, source and size share what is
    taken of them equally, the first ones a word more."""
    pieces, sizes, wanted = mix(docs, block)
    keys = ("doc_id", "source", "size")
    got = pieces.groupBy(*keys).agg(F.sum(F.col("to_word") - F.col("from_word")).alias("words"))
    rows = sizes.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    per = null_safe_join(rows, got, list(keys), "left").withColumn("words", F.coalesce("words", F.lit(0).cast("long")))
    each = per.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    share = (F.col("words") / F.col("copies")).cast("long") + F.when(F.col("copy") <= F.col("words") % F.col("copies"), 1).otherwise(0)
    return null_safe_join(each, wanted, ["source"]).select("doc_id", "size", "source_size", "target", share.alias("taken"))


def mixed_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of `docs`, with their columns, once for every reading in which the mix takes their first word. Rows without words are no part
    of a mix."""
    pieces, _, _ = mix(docs, block)
    keys = ["doc_id", "source", "size"]
    times = pieces.where("from_word = 0").groupBy(*keys, "row").agg(F.count(F.lit(1)).alias("times"))
    # rows with equal keys are told apart by a number, in the order of their texts
    times = times.select(*keys, "times", F.row_number().over(W.partitionBy(*keys).orderBy("row")).alias("copy"))
    named = docs.withColumns({
        "__doc_id": F.col("doc_id").cast("long"), "__source": F.col("source").cast("string"), "__size": n_words(F.col("text"))})
    numbered = named.withColumn("__copy", F.row_number().over(W.partitionBy("__doc_id", "__source", "__size").orderBy("text")))
    times = times.select(*[F.col(c).alias(f"__{c}") for c in (*keys, "copy")], "times").withColumnRenamed("times", "__times")
    joined = null_safe_join(numbered, times, ["__doc_id", "__source", "__size", "__copy"])
    repeated = joined.withColumn("__time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
