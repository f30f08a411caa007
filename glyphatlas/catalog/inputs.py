"""Inputs that the catalog derives from the driver's tables; always whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphatlas.operators.graph import WHOLE_ID_PATTERN, canonical, extract_edges
from glyphatlas.vocab import ENUM_DOMAINS


# The test tables are single row groups, which Spark reads in one task. Tables below this size are spread
# over all cores before heavy expressions; larger ones come in enough splits of their own.
_SMALL = 1 << 30
# Narrow rows that turn into many wide ones are spread at every size, so that a task has about as many whatever the table holds.
_SHARE = 16 << 20


def table(spark: SparkSession, sf: str, name: str, spread: str | None = None, by_size: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() if spread else 0
    if spread and (by_size or size < _SMALL):
        return df.repartition(max(spark.sparkContext.defaultParallelism, size // _SHARE if by_size else 0), spread)
    return df


# --- tagged texts ---------------------------------------------------------------------------

_ID = "concat('A', lpad(cast(doc_id as string), greatest(6, length(cast(doc_id as string))), '0'))"
_FIRST = "substring_index(text, '\n', 1)"
_REST = "CASE WHEN instr(text, '\n') > 0 THEN substring(text, instr(text, '\n') + 1) ELSE '' END"
_STAMP = (
    "concat_ws(' ', element_at(array('Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'),"
    " cast(1 + doc_id % 12 as int)), lpad(cast(1 + doc_id % 28 as string), 2, '0'), cast(1990 + doc_id % 35 as string),"
    " concat_ws(':', lpad(cast(doc_id % 24 as string), 2, '0'), lpad(cast(doc_id % 60 as string), 2, '0'),"
    " CASE WHEN doc_id % 13 = 5 THEN '60' ELSE lpad(cast((doc_id * 7) % 60 as string), 2, '0') END))"
)
_TERMS = (
    "transform(sequence(0L, doc_id % 20), i -> CASE WHEN i = 2 AND doc_id % 11 = 0 THEN '99999999999999999999'"
    " WHEN i = 1 AND doc_id % 17 = 0 THEN 'x' ELSE cast(doc_id + i as string) END)"
)


def _when(test: str, *lines: str) -> str:
    items = ", ".join(lines)
    return f"CASE WHEN {test} THEN array({items}) ELSE cast(array() as array<string>) END"


def _line(code: str, content: str) -> str:
    return f"concat('%{code} ', id, ' ', {content})"


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    """(path, mtime, size, text): every document as one tagged text.

    Broken and legacy headers, blank and repeated single fields, several value chunks with loose commas,
    overflowing and non-numeric terms, an early value-file link, code that is not a tag and both kinds of
    line break are spread over the documents by arithmetic on doc_id.
    """
    docs = table(spark, sf, "documents", "doc_id").selectExpr(
        "doc_id", "lang", "source", "n_chars", f"{_ID} AS id", f"{_FIRST} AS first", f"{_REST} AS rest",
        "instr(text, '\n') > 0 AS more", f"{_STAMP} AS stamp", f"{_TERMS} AS terms")
    bfile = "concat('<a href=\"/', id, '/b', substring(id, 2), '.txt\">terms</a>')"
    parts = [
        _when("doc_id % 10 = 9", _line("H", bfile)),
        "array(concat('%I ', id, CASE WHEN doc_id % 7 = 3 THEN ' M0003' WHEN doc_id % 3 = 0 THEN ' M0098 N0035' ELSE '' END,"
        " ' #', cast(n_chars as string), ' ', stamp))",
        "array('stray text without a code')",
        f"array(concat('%N ', id, '    '), {_line('N', "concat('  ', first, '  ')")}, {_line('N', "'a later name'")})",
        _when("doc_id % 23 <> 0", _line("S", "concat(array_join(slice(terms, 1, 3), ','), ',,,')")),
        _when("doc_id % 23 <> 0 AND size(terms) > 3", _line("T", "concat(array_join(slice(terms, 4, 100), ', '), ',')")),
        f"CASE WHEN more THEN transform(split(rest, '\n'), c -> {_line('C', 'c')}) ELSE cast(array() as array<string>) END",
        f"array({_line('F', "concat('a(n) = ', cast(doc_id as string), '*n')")})",
        _when("doc_id % 2 = 1", _line("F", "' G.f.: x/(1-x)'")),
        f"array({_line('e', "concat('  ', lang, ' sample')")})",
        _when("doc_id % 5 = 0", _line("K", "' , ,'")),
        f"array({_line('K', "concat(lang, ',', source, ', ,nonn')")}, {_line('K', "'ignored'")})",
        f"array({_line('O', "concat(cast(doc_id % 3 as string), ',1')")}, {_line('A', "concat('_', source, '_, Jan 01 2000')")})",
        f"array_repeat({_line('D', "'A reference'")}, cast(doc_id % 4 as int))",
        f"array_repeat({_line('H', "'A link'")}, cast(doc_id % 3 as int))",
        _when("doc_id % 2 = 0", _line("H", bfile)),
        _when("doc_id % 2 = 1", _line("E", "'Extended'")),
        _when("doc_id % 5 = 1", _line("p", "'seq(n, n=1..9);'")),
        _when("doc_id % 5 IN (2, 3)", _line("t", "'Table[n, {n, 9}]'")),
        _when("doc_id % 5 >= 2", _line("o", "'(PARI) a(n) = n'")),
        _when("doc_id % 5 = 4", _line("o", "'(Python 3) print(n)'")),
        f"array({_line('o', "'(define (x y))'")})",
        _when("doc_id % 4 = 1", _line("o", "' (C++) int a;'")),
        _when("doc_id % 6 = 0", _line("o", "'(Brainfuck) +'")),
        f"array({_line('Y', "'Cf. A000001.'")})",
    ]
    lines = docs.selectExpr("doc_id", "id", f"concat({', '.join(parts)}) AS lines")
    return lines.selectExpr(
        "concat('tagged/', substring(id, 1, 4), '/', lower(id), '.seq') AS path",
        "cast(1700000000 + doc_id as double) AS mtime",
        "array_join(lines, CASE WHEN doc_id % 3 = 1 THEN '\r\n' ELSE '\n' END) AS text",
    ).selectExpr("path", "mtime", "cast(octet_length(text) as bigint) AS size", "text")


# --- records --------------------------------------------------------------------------------


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their labels as raw records."""
    docs = table(spark, sf, "documents", "doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    keep = lambda test, word: f"CASE WHEN {test} THEN '{word}' END"
    words = ["lang", "source", keep("doc_id % 50 = 0", "core"), keep("quality = 1", "nice"), keep("toxic = 1", "dead"),
             keep("doc_id % 3 = 0", "tabl"), keep("doc_id % 4 = 1", "sign"), keep("doc_id % 7 = 2", "mult"), "'nonn'",
             keep("doc_id % 2 = 1", "easy")]
    return docs.selectExpr(
        "doc_id",
        f"{_ID} AS id",
        f"CASE WHEN doc_id % 97 = 13 THEN '' ELSE {_FIRST} END AS name",
        "text AS comments",
        f"{_REST} AS formulas",
        f"concat(lang, ' ', source, ': ', {_FIRST}) AS examples",
        f"filter(array({', '.join(words)}), k -> k IS NOT NULL) AS keywords",
        "concat(cast(doc_id % 3 as string), ',1') AS offset",
        "concat_ws(', ', cast(doc_id as string), cast(doc_id + 1 as string), cast(doc_id + 2 as string)) AS values_preview_str",
        "doc_id % 40 AS n_terms_visible",
        "CASE doc_id % 6 WHEN 0 THEN concat('_Ann ', source, '_, Jan 01 2000') WHEN 1 THEN concat('_', source, '_ and _Bob_')"
        " WHEN 2 THEN concat('Jane ', source, ' and John Roe') WHEN 3 THEN concat(source, ' (mail(AT)example.org), Feb 02 1993')"
        " WHEN 5 THEN '' END AS author",
        "n_chars AS edit_count",
        "CASE WHEN doc_id % 25 <> 3 THEN make_timestamp_ntz(cast(1990 + doc_id % 35 as int), 6, 15, 12, 0, 0) END AS last_edited",
        "doc_id % 7 AS n_references",
        "doc_id % 11 AS n_links",
        "doc_id % 2 AS n_extensions",
        "slice(array('c', 'gap', 'maple', 'pari'), 1, cast(doc_id % 5 as int)) AS code_languages",
        "quality",
        "toxic",
    )


def _pick(field: str, index: str) -> str:
    values = ", ".join(f"'{v}'" for v in ENUM_DOMAINS[field])
    return f"element_at(array({values}), cast(({index}) % {len(ENUM_DOMAINS[field])} + 1 as int))"


# field -> (index for the first annotator, rows where the second differs, null rows of the first and second)
_ANNOTATIONS = {
    "math_domain": ("doc_id * 7 + coalesce(quality, 0) * 3", "doc_id % 5 = 0", "false", "doc_id % 8 = 0"),
    "sequence_type": ("doc_id * 5 + coalesce(toxic, 0)", "doc_id % 4 = 1", "false", "false"),
    "growth_class": ("n_chars", "false", "doc_id % 20 = 7", "doc_id % 9 = 2"),
    "origin_era": ("doc_id", "doc_id % 6 = 0", "false", "false"),
}


def annotator(spark: SparkSession, sf: str, which: str) -> DataFrame:
    """Annotator `a`, or `b`: the same with shifted, missing and out-of-domain values."""
    docs = table(spark, sf, "documents", "doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    cols = []
    for field, (index, shifted, null_a, null_b) in _ANNOTATIONS.items():
        if which == "a":
            cols.append(f"CASE WHEN NOT ({null_a}) THEN {_pick(field, index)} END AS {field}")
        else:
            typo = "WHEN doc_id % 10 = 7 THEN 'chemistry_physics' " if field == "math_domain" else ""
            value = _pick(field, f"{index} + CASE WHEN {shifted} THEN 1 ELSE 0 END")
            cols.append(f"CASE WHEN {null_b} THEN NULL {typo}ELSE {value} END AS {field}")
    return docs.selectExpr(
        "doc_id", f"{_ID} AS id", f"{_FIRST} AS name", "cast(doc_id as string) AS values_preview_str", *cols)


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    fields = annotator(spark, sf, "a").select("id", *ENUM_DOMAINS)
    return records(spark, sf).join(fields, "id")


# --- graphs and vectors ---------------------------------------------------------------------


def xref(spark: SparkSession, sf: str) -> DataFrame:
    """(text): one cross-reference line per line item, from its order to its part and its supplier. Some
    lines are bare, some ids run on for a seventh digit."""
    return table(spark, sf, "lineitem", "l_orderkey", by_size=True).selectExpr(
        "concat('%Y A', lpad(cast(l_orderkey as string), greatest(6, length(cast(l_orderkey as string))), '0'), CASE WHEN l_linenumber = 6 THEN '' ELSE concat(' Cf. A',"
        " lpad(cast(l_partkey as string), greatest(6, length(cast(l_partkey as string))), '0'), CASE WHEN l_linenumber = 7 THEN '9' ELSE '' END, ', A',"
        " lpad(cast(l_suppkey as string), greatest(6, length(cast(l_suppkey as string))), '0'), '.') END) AS text")


def xref_edges(spark: SparkSession, sf: str) -> DataFrame:
    return canonical(extract_edges(xref(spark, sf), id_pattern=WHOLE_ID_PATTERN))


def order_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr("concat('A', lpad(cast(o_orderkey as string), greatest(6, length(cast(o_orderkey as string))), '0')) AS id")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").selectExpr("vec_id AS id", "cast(embedding as array<double>) AS embedding", "label")


def vector_edges(spark: SparkSession, sf: str) -> DataFrame:
    """(from_id, to_id) between vectors, one try per customer. Squares leave some nodes without edges, and
    one id in eleven lies outside the vectors."""
    m = vectors(spark, sf).agg((F.floor(F.count(F.lit(1)) * 11 / 10)).alias("m")).scalar()
    key = F.col("c_custkey")
    pairs = table(spark, sf, "customer").select(
        F.pmod(key * key, m).alias("src"), F.pmod(F.round(F.col("c_acctbal") * 100).cast("bigint"), m).alias("dst"))
    return canonical(pairs.where("src <> dst"))


def classes(spark: SparkSession, sf: str) -> DataFrame:
    """(id, classes): label and parity of every vector."""
    return vectors(spark, sf).selectExpr(
        "id", "array(cast(label as string), CASE WHEN id % 2 = 0 THEN 'even' ELSE 'odd' END) AS classes")


def layers(spark: SparkSession, sf: str) -> DataFrame:
    """(id, layer, cluster_id): labels as the fine layer, thirds of them as the coarse one, with noise."""
    return vectors(spark, sf).selectExpr(
        "id", "stack(2, 0, floor(label / 3), 1, cast(label as bigint)) AS (layer, c)").selectExpr(
        "id", "layer", "CASE WHEN id % 13 = 0 THEN -1L ELSE c END AS cluster_id")


def layer_labels(spark: SparkSession, sf: str) -> DataFrame:
    return layers(spark, sf).selectExpr(
        "id", "layer", "cluster_id",
        "CASE WHEN cluster_id < 0 THEN 'Unlabelled' ELSE concat('topic ', cast(cluster_id as string)) END AS label")


def source_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in two layers: language (0) and source (1)."""
    return table(spark, sf, "documents", "doc_id").selectExpr(
        "doc_id AS id", "text",
        "stack(2, 0, CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END, 1,"
        " cast(substring(source, 4) as int)) AS (layer, c)").selectExpr("id", "text", "layer", "cast(c as bigint) AS cluster_id")
