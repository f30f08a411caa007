"""MinHash near-duplicates by a multi-index Hamming join.

1. A document is the set of its distinct `k`-word shingles. Equal sets are one class from the start (a digest of the set,
   grouped with the smallest doc_id), so a group of copies is one row from here on.
2. A signature holds `CHUNKS` * `PER_CHUNK` minima of `BITS` bits, a chunk in one long. Two signatures that differ in at most `GUARANTEED` values
   have, by pigeonhole, a chunk with at most one wrong value: all keys of a chunk with one value left out are
   enumerated, and such a pair shares a key. With 7 chunks of 4 values, sets at a similarity of 0.85 share no key with a
   probability of 2e-7, at 0.8 of 6e-6.
3. Within a key, members are not paired with each other: each is compared with a hub of the key, at first the member that
   shares keys with most others, then, where components still differ, a member drawn anew for every key. A second
   signature of `LONG_VALUES` short minima tells which pairs are worth the full sets: sets at the asked similarity differ in more
   than `_farthest` of them with a probability of at most `LONG_MISS`. Confirmed links are contracted to components.
4. What is left: members of a key outside its first hub's component meet the members of other components by the rarest shingles of
   their full sets (`_left_over`), and both signatures. So no link between two components is given up, and families
   of texts that fall just short of each other cost little more than their own length.

Defined results: documents without words, and rows without doc_id, are linked with nothing and kept; texts of fewer than `k`
words are one shingle of all their words; rows that share a doc_id share a component; of equal sets the smallest doc_id
stays. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphatlas.llm.common import MIX, Words, doc_texts, in_pieces, join_with_hot_keys, keep_ids, mixed, utf8
from glyphatlas.operators.components import contract
from glyphatlas.session import cut_lineage, discard, settle

CHUNKS, PER_CHUNK, BITS = 7, 4, 14
VALUES = CHUNKS * PER_CHUNK
GUARANTEED = 2 * CHUNKS - 1
FARTHEST = 16
DRAWN_ROUNDS = 1
SIZE_STEP = 1.02
# Bits that mark the shingles of left-over sets: 8 MB, at any size of the input.
MARK_BITS = 26
# A value has BITS bits and one spare, so that adding ONES carries into the spare bit unless the value is 0.
LANE = BITS + 1
ONES = sum(((1 << BITS) - 1) << (LANE * i) for i in range(PER_CHUNK))
SPARE = sum(1 << (LANE * i + BITS) for i in range(PER_CHUNK))
SIG = [f"s{c}" for c in range(CHUNKS)]
LONG_VALUES, LONG_BITS, LONG_EACH, LONG_MISS = 196, 7, 7, 2e-6
LONG_ONES = sum(((1 << LONG_BITS) - 1) << ((LONG_BITS + 1) * i) for i in range(LONG_EACH))
LONG_SPARE = sum(1 << ((LONG_BITS + 1) * i + LONG_BITS) for i in range(LONG_EACH))
LONG = [f"l{c}" for c in range(LONG_VALUES // LONG_EACH)]
_TURNS = mixed(np.arange(1, VALUES + LONG_VALUES + 1).astype(np.uint64) * MIX) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles, row after row."""
    words = Words(data, offsets)
    row, shingle = words.shingles(k)
    n = np.diff(words.first)
    few = np.flatnonzero((n > 0) & (n < k))
    if len(few):
        whole = np.zeros(len(few), np.uint64)
        for i in range(k - 1):
            more = n[few] > i
            whole[more] = mixed(whole[more] * MIX + words.hash[words.first[few[more]] + i] + np.uint64(i + 1))
        row, shingle = np.concatenate([row, few]), np.concatenate([shingle, whole])
        order = np.argsort(row, kind="stable")
        row, shingle = row[order], shingle[order]
    own = np.unique(mixed(shingle + row.astype(np.uint64) * MIX), return_index=True)[1]
    own.sort()
    return row[own], shingle[own]


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, s0, s1, ..., l0, l1, ...): two digests of the set, and its signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, 1 << 19):
            rows = batch.num_rows
            row, shingle = shingle_sets(*utf8(batch.column(1)), k)
            n = np.bincount(row, minlength=rows)
            full = np.flatnonzero(n)
            begin = (np.cumsum(n) - n)[full]
            d1, d2 = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            sig = np.zeros((CHUNKS + len(LONG), rows), np.int64)
            if len(full):
                d1[full] = np.add.reduceat(shingle, begin)
                d2[full] = np.bitwise_xor.reduceat(mixed(shingle), begin)
                for i, turn in enumerate(_TURNS):
                    low = np.minimum.reduceat(shingle * turn, begin)
                    if i < VALUES:
                        value = (mixed(low) >> np.uint64(64 - BITS)).astype(np.int64)
                        sig[i // PER_CHUNK, full] |= value << (LANE * (i % PER_CHUNK))
                    else:
                        value = (mixed(low) >> np.uint64(64 - LONG_BITS)).astype(np.int64)
                        sig[CHUNKS + (i - VALUES) // LONG_EACH, full] |= value << ((LONG_BITS + 1) * ((i - VALUES) % LONG_EACH))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), *map(pa.array, sig)],
                ["doc_id", "n_shingles", "d1", "d2", *SIG, *LONG])

    return doc_texts(docs).mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, " + ", ".join(f"{c} long" for c in SIG + LONG))


def _keys() -> Column:
    """(slot, key): every chunk with every single value left out."""
    out = []
    for c in range(CHUNKS):
        for left_out in range(PER_CHUNK):
            rest = (1 << (LANE * PER_CHUNK)) - 1 - (((1 << LANE) - 1) << (LANE * left_out))
            out.append(F.xxhash64(F.lit(c * PER_CHUNK + left_out), F.col(SIG[c]).bitwiseAND(F.lit(rest))))
    return F.posexplode(F.array(*out)).alias("slot", "key")


def _alike(percent: int) -> Column:
    """Whether the sizes of the members x and y allow the similarity."""
    return (100 * F.col("x_n") >= percent * F.col("y_n")) & (100 * F.col("y_n") >= percent * F.col("x_n"))


def _wrong(c: str) -> Column:
    """How many values of a chunk differ between the members x and y."""
    return F.bit_count((F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}")) + F.lit(ONES)).bitwiseAND(F.lit(SPARE)))


def _near() -> Column:
    """Whether the signatures of the members x and y differ in at most FARTHEST values."""
    return sum((_wrong(c) for c in SIG[1:]), _wrong(SIG[0])) <= FARTHEST


def _farthest(percent: int) -> int:
    """The largest distance of the second signatures at which sets of the similarity are still expected."""
    p = (1 - percent / 100) * (1 - 2.0 ** -LONG_BITS)
    most, beyond = LONG_VALUES, 0.0
    while most > 0:
        beyond += comb(LONG_VALUES, most) * p ** most * (1 - p) ** (LONG_VALUES - most)
        if beyond > LONG_MISS:
            break
        most -= 1
    return most


def _long_near(percent: int) -> Column:
    each = [F.bit_count((F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}")) + F.lit(LONG_ONES)).bitwiseAND(F.lit(LONG_SPARE))) for c in LONG]
    return sum(each[1:], each[0]) <= _farthest(percent)


def _as(member: str, frame: DataFrame, *more: str) -> DataFrame:
    """The columns of a member, with its name in front."""
    return frame.select(*more, *[F.col(c).alias(f"{member}_{'n' if c == 'n_shingles' else c}") for c in ("rep", "n_shingles", *SIG, *LONG) if c in frame.columns])


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(rep, shingles): the sorted hashes of the sets of the wanted documents, as one binary value; one row for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, 1 << 19):
            row, shingle = shingle_sets(*utf8(batch.column(1)), k)
            ends = np.cumsum(np.bincount(row, minlength=batch.num_rows))
            parts = [np.sort(shingle[a:b]).tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary())], ["rep", "shingles"])

    texts = doc_texts(docs).where("doc_id IS NOT NULL").join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")
    return texts.mapInArrow(run, "rep long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = 100 * both >= percent * (len(x) + len(y) - both) > 0
            yield batch.select([0, 1]).filter(pa.array(good))

    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def _distinct_pairs(found: DataFrame) -> DataFrame:
    return found.select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b")).where("a < b").distinct()


def _with_roots(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return members.withColumn("root", F.col("rep"))
    return members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))


def _centres(hubs: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(key, hub, hub_root): the hubs with their components."""
    return _with_roots(hubs.withColumnRenamed("hub", "rep"), roots).withColumnsRenamed({"rep": "hub", "root": "hub_root"})


def _hub_pairs(labelled: DataFrame, centre: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a member and the hub of one of its keys, in different components and near enough."""
    # written in steps: the driver keeps what it knows of a plan once for every time that a part of it ends
    met = labelled.join(centre, "key").where("root <> hub_root").select(F.col("rep").alias("x_rep"), F.col("hub").alias("y_rep"))
    apart = settle(met.distinct())
    short = classes.select("rep", "n_shingles", *LONG)
    sized = apart.join(_as("x", short), "x_rep").join(_as("y", short), "y_rep")
    found = settle(_distinct_pairs(sized.where(_alike(percent) & _long_near(percent))))
    discard(apart)
    return found


def _bit(shingle: np.ndarray) -> np.ndarray:
    return (shingle.view(np.uint64) >> np.uint64(64 - MARK_BITS)).astype(np.int64)


def _marked_shingles(sets: DataFrame) -> np.ndarray:
    """A bitmap of 2 ** MARK_BITS bits, whatever the data, with a bit for every shingle of the sets (shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.unique(_bit(np.frombuffer(b"".join(x.as_py() for x in batch.column(0)), np.int64)))
            word = bits // 64
            first = np.flatnonzero(np.diff(word, prepend=-1))
            held = np.bitwise_or.reduceat(np.uint64(1) << (bits % 64).astype(np.uint64), first) if len(bits) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(held.view(np.int64))], ["word", "bits"])

    words = sets.select("shingles").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros((1 << MARK_BITS) // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def _shingle_rows(frame: DataFrame, percent: int) -> DataFrame:
    """(rep, root, minor, own, n, outside, shingle) for (rep, root, minor, shingles), written: a row for every shingle that may stand in a minor set; `outside` is how
    many of the set's `n` shingles stand in none, and `own` tells the sets of a rep apart. Sets with too few shingles in minor sets are left out."""
    shipped = frame.sparkSession.sparkContext.broadcast(_marked_shingles(frame.where("minor")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                held = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(4)]
                n = np.array([len(x) for x in held])
                flat, row = np.concatenate(held), np.repeat(np.arange(len(n)), n)
                bit = _bit(flat)
                inside = (known[bit // 64] >> (bit % 64).astype(np.uint64) & np.uint64(1)).astype(bool)
                many = np.bincount(row[inside], minlength=len(n))
                keep = inside & (100 * many >= percent * n)[row]
                row = row[keep]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i).take(pa.array(row)) for i in range(4)), pa.array(n[row]), pa.array((n - many)[row]), pa.array(flat[keep])],
                    ["rep", "root", "minor", "own", "n", "outside", "shingle"])

    cut = frame.select("rep", "root", "minor", F.xxhash64("shingles").alias("own"), "shingles")
    rows = settle(cut.mapInArrow(run, "rep long, root long, minor boolean, own long, n long, outside long, shingle long"))
    shipped.destroy()
    return rows


def _overlap(x: Column, y: Column, percent: int) -> Column:
    """The fewest common shingles of sets of these sizes with the similarity."""
    return F.ceil(percent * (x + y) / F.lit(100.0 + percent) - 1e-9)


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(SIZE_STEP)) + 1e-9)


def _left_over(labelled: DataFrame, centre: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) in different components that share a key, one of them outside the component of the key's hub, and that can still be similar enough.

    Signatures cannot tell sets that just miss the similarity from those that reach it, and a family of such texts has very many pairs. The
    sets themselves can: put the shingles of all sets concerned in order, those of no minor set in front and rare ones next. Two sets with enough in common
    share their first common shingle within the first size - overlap + 1 of either set, and texts that differ have their own words in front. So
    sets meet by these first shingles and the size of the other one (in classes of 2%), and near misses with own words never meet.
    """
    minor = settle(labelled.join(centre, "key").where("root <> hub_root").select("key", "rep"))
    left = minor.select("rep").distinct().withColumn("minor", F.lit(True))
    concerned = labelled.join(minor.select("key").distinct(), "key", "left_semi").select("rep", "root").distinct()
    marked = settle(concerned.join(left, "rep", "left").select("rep", "root", F.coalesce("minor", F.lit(False)).alias("minor")))
    rows = _shingle_rows(marked.join(sets, "rep").select("rep", "root", "minor", "shingles"), percent)
    counts = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets"))
    placed = join_with_hot_keys(rows, counts, ["shingle"], "sets").withColumn(
        "place", F.col("outside") + F.row_number().over(W.partitionBy("rep", "own").orderBy("sets", "shingle")))
    n = F.col("n")
    least = F.ceil(n * percent / F.lit(100.0) - 1e-9)
    first = settle(placed.where(F.col("place") <= n - least + 1).select("rep", "root", "minor", "n", "place", "shingle"))
    each = F.explode(F.sequence(_size_class(least), _size_class(F.floor(n * 100 / F.lit(float(percent)) + 1e-9)))).alias("of_size")
    asked = first.where("minor").select("*", each)
    smallest = F.greatest(F.floor(F.pow(F.lit(SIZE_STEP), F.col("of_size")) - 1e-6), least)
    asked = asked.where(F.col("place") <= n - _overlap(n, smallest, percent) + 1)
    x = asked.select("shingle", "of_size", *[F.col(c).alias(f"x_{c}") for c in ("rep", "root", "n", "place")])
    y = first.select("shingle", _size_class(n).alias("of_size"), *[F.col(c).alias(f"y_{c}") for c in ("rep", "root", "n", "place")])
    enough = _overlap(F.col("x_n"), F.col("y_n"), percent)
    meet = (F.col("x_place") <= F.col("x_n") - enough + 1) & (F.col("y_place") <= F.col("y_n") - enough + 1)
    met = settle(x.join(y, ["shingle", "of_size"]).where((F.col("x_root") != F.col("y_root")) & meet).select("x_rep", "y_rep").distinct())
    signed = met.join(_as("x", classes), "x_rep").join(_as("y", classes), "y_rep")
    found = settle(_distinct_pairs(signed.where(_alike(percent) & _near() & _long_near(percent))))
    discard(minor, marked, rows, first, met)
    return found


def _same_ids(usable: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links (a, b) between the classes of rows that share a doc_id, or None if no texts do."""
    differ = (F.min("d1") != F.max("d1")) | (F.min("d2") != F.max("d2"))
    shared = cut_lineage(usable.groupBy("doc_id").agg(differ.alias("differ")).where("differ").select("doc_id"))
    if shared.isEmpty():
        return None
    own = usable.join(shared, "doc_id", "left_semi").select("doc_id", "n_shingles", "d1", "d2")
    reps = cut_lineage(own.join(classes.select("n_shingles", "d1", "d2", "rep"), ["n_shingles", "d1", "d2"]).select("doc_id", "rep"))
    first = reps.groupBy("doc_id").agg(F.min("rep").alias("a"))
    found = cut_lineage(reps.join(first, "doc_id").select("a", F.col("rep").alias("b")).where("a < b").distinct())
    return None if found.isEmpty() else found


def components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`."""
    signed = cut_lineage(signatures(docs, k))
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(usable.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"), *[F.min(c).alias(c) for c in SIG + LONG]))
    # rows with different texts may share a doc_id: then it stands for several classes, each with its own signatures and set
    member = classes.select("rep", "n_shingles", *SIG, *LONG)
    keyed = classes.select("rep", _keys())
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # AQE splits a key that holds many rows; the counts are one row per key
    members = settle(keyed.join(shared, "key").select("key", "slot", "rep", "members"))
    degree = members.groupBy("rep").agg(F.sum("members").alias("degree"))
    ranked = members.join(degree, "rep").groupBy("key").agg(F.max(F.struct("degree", (-F.col("rep")).alias("minus"))).alias("best"))
    hubs = settle(ranked.select("key", (-F.col("best.minus")).alias("hub")))
    sets = full_sets(docs, members.select("rep").distinct(), k)
    each = [F.xxhash64("shingles").alias("h1"), F.xxhash64(F.lit(1), "shingles").alias("h2")]
    sets = settle(sets.groupBy("rep", *each).agg(F.max("shingles").alias("shingles")).select("rep", "shingles"))
    links = _same_ids(usable, classes)
    roots = None if links is None else contract(links)
    labelled = _with_roots(members, None) if roots is None else cut_lineage(_with_roots(members, roots))
    for turn in range(DRAWN_ROUNDS + 2):
        if turn == 0:
            pairs = _hub_pairs(labelled, _centres(hubs, roots), member, percent)
        elif turn <= DRAWN_ROUNDS:
            drawn = F.min(F.struct(F.xxhash64("key", "rep", F.lit(turn)).alias("draw"), "rep"))
            drawn = members.groupBy("key").agg(drawn.alias("d")).select("key", F.col("d.rep").alias("hub"))
            pairs = _hub_pairs(labelled, _centres(drawn, roots), member, percent)
        else:
            pairs = _left_over(labelled, _centres(hubs, roots), member, sets, percent)
        found = cut_lineage(confirmed(pairs, sets, percent))
        discard(pairs)
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            roots = contract(links)
            if turn <= DRAWN_ROUNDS:
                labelled = cut_lineage(_with_roots(members, roots))
    discard(members, hubs, sets)
    named = _with_roots(classes.select("n_shingles", "d1", "d2", "rep"), roots).select("n_shingles", "d1", "d2", F.col("root").alias("class_root"))
    found = signed.select("doc_id", "n_shingles", "d1", "d2").join(named, ["n_shingles", "d1", "d2"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0) | F.col("class_root").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.least("class_root", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def first_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one document of each component. A doc_id stays in one row."""
    kept = settle(components(docs, k, percent).where("kept").select("doc_id").where("doc_id IS NOT NULL"))
    stay = keep_ids(docs.where("doc_id IS NOT NULL"), kept)
    # only rows that share their doc_id have to meet
    again = settle(docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id"))
    if not again.isEmpty():
        stay = keep_ids(stay, again, "left_anti").unionByName(keep_ids(stay, again).dropDuplicates(["doc_id"]))
    return stay.unionByName(docs.where("doc_id IS NULL"))
