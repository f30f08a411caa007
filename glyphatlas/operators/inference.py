"""Model-backed jobs over a table: batched classification and embedding with resume and validation.

Models are plain callables that get one batch of rows. Spark decides where batches run; a worker only cuts
its Arrow batches into model batches and lines the answers up with the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphatlas.functions.compose import prompt_entry
from glyphatlas.operators.naming import terms
from glyphatlas.operators.ranking import with_position
from glyphatlas.session import settle
from glyphatlas.vocab import (
    CLASSIFY_BATCH,
    EMBED_BATCH,
    EMBED_TEXT_VERSION,
    ENUM_DOMAINS,
    ENUM_FALLBACK,
    ENUM_FIELDS,
)

# A classifier takes rows and returns (items, input tokens, output tokens); an item holds `index`, the
# 0-based place of its row in the batch, and the fields.
Classifier = Callable[[list[dict]], tuple[list[dict], int, int]]
Embedder = Callable[[list[str]], list[list[float]]]


def validate_enum(value: Column, field: str, domains: Mapping = ENUM_DOMAINS, fallback: Mapping = ENUM_FALLBACK) -> Column:
    """Null stays null (the row is to be done again); a value outside the domain becomes the fallback."""
    return F.when(value.isin(*domains[field]), value).when(value.isNotNull(), F.lit(fallback[field]))


def validated(df: DataFrame, fields=ENUM_FIELDS) -> DataFrame:
    return df.withColumns({f: validate_enum(F.col(f), f) for f in fields})


def with_batches(df: DataFrame, order: list[Column], size: int = CLASSIFY_BATCH, by: tuple[str, ...] = ("id",)) -> DataFrame:
    """Add (batch_id, place): consecutive rows in `order`, `size` to a batch, places from 0. Only `id` and the columns `by`, which `order` reads, are
    put in order; the wide rows get their numbers by id."""
    placed = with_position(df.select(*{"id": 0, **dict.fromkeys(by)}), order, "_p").select("id", "_p")
    numbered = df.join(placed, "id")
    return numbered.withColumn("batch_id", F.floor(F.col("_p") / size)).withColumn("place", F.col("_p") % size).drop("_p")


def batch_prompts(batches: DataFrame, noun: str = "records", title: str = "Sequence") -> DataFrame:
    """(batch_id, n_rows, prompt): one numbered prompt per batch; a batch is bounded by its size."""
    entries = batches.select("batch_id", "place", prompt_entry(F.col("place"), title).alias("entry"))
    grouped = entries.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.array_sort(F.collect_list(F.struct("place", "entry"))).alias("e"))
    opening = F.concat(
        F.lit("Classify the following "), F.col("n_rows").cast("string"),
        F.lit(f" {noun}. Return one classification per {title.lower()} using its 0-based index."))
    body = F.array_join(F.transform("e", lambda x: x["entry"]), "\n")
    return grouped.select("batch_id", "n_rows", F.concat(opening, F.lit("\n"), body).alias("prompt"))


def align_responses(batches: DataFrame, responses: DataFrame, fields=ENUM_FIELDS) -> DataFrame:
    """(id, fields...): answers (batch_id, index, seq, fields...) lined up with their rows.

    The last answer for an index wins, a row without an answer gets nulls, answers for places that do not
    exist are dropped, and values are validated.
    """
    last = responses.groupBy("batch_id", "index").agg(F.max_by(F.struct(*fields), "seq").alias("r"))
    joined = batches.join(last.withColumnRenamed("index", "place"), ["batch_id", "place"], "left")
    return joined.select("id", *[validate_enum(F.col(f"r.{f}"), f).alias(f) for f in fields])


def classify(
    df: DataFrame, classifier: Classifier, columns: tuple[str, ...], fields=ENUM_FIELDS, batch_size: int = CLASSIFY_BATCH
) -> DataFrame:
    """(id, fields..., input_tokens, output_tokens, error), one row per row of `df`.

    Only `id` and `columns` travel to the workers. A batch whose call fails gets nulls and the reason in `error`, so
    the next run picks its rows up again. Token use is a column on the first row of each batch.
    """
    text, whole = T.StringType(), T.LongType()
    schema = T.StructType([df.schema["id"], *[T.StructField(f, text) for f in fields],
                           T.StructField("input_tokens", whole), T.StructField("output_tokens", whole), T.StructField("error", text)])

    def run(frames):
        import pandas as pd

        for frame in frames:
            for at in range(0, len(frame), batch_size):
                error = None
                rows = frame.iloc[at : at + batch_size].to_dict("records")
                try:
                    items, used_in, used_out = classifier(rows)
                except Exception as fault:  # the service's own kinds are not known here; the reason is kept
                    items, used_in, used_out, error = [], 0, 0, f"{type(fault).__name__}: {fault}"[:1000]
                by_index = {int(i["index"]): i for i in items if isinstance(i, dict) and "index" in i}
                answers = [by_index.get(j, {}) for j in range(len(rows))]
                cell = lambda a, f: None if a.get(f) is None else str(a[f])
                out = {"id": [r["id"] for r in rows], **{f: [cell(a, f) for a in answers] for f in fields}}
                rest = [0] * (len(rows) - 1)
                yield pd.DataFrame({
                    **out, "input_tokens": [used_in, *rest], "output_tokens": [used_out, *rest], "error": pd.Series([error] * len(rows), dtype="object")})

    needed = df.select("id", *[c for c in columns if c != "id"])
    return validated(needed.mapInPandas(run, schema), fields)


# Fixed rules of the default classifier: field -> ((value, keyword or None, pattern or None), ...); first match wins.
RULES = {
    "math_domain": (
        ("analysis", "cons", None),
        ("number_theory", "mult", None),
        ("combinatorics", "tabl", None),
        ("recreational", "base", None),
        ("graph_theory", None, r"\b(graph|tree|network)s?\b"),
        ("geometry", None, r"\b(area|volume|polytope)s?\b"),
        ("number_theory", None, r"\b(prime|divisor)s?\b"),
    ),
    "sequence_type": (
        ("table_flattened", "tabl", None),
        ("table_flattened", "tabf", None),
        ("constant_digits", "cons", None),
        ("arithmetic_function", "mult", None),
        ("enumeration", None, r"\bnumber of\b"),
    ),
    "growth_class": (("finite", "fini", None), ("finite", "full", None), ("oscillating", "sign", None), ("bounded", "cons", None)),
    "origin_era": (
        ("modern_post2000", None, r"\b20[0-9]{2}\b"),
        ("mid_20c_1950_2000", None, r"\b19[5-9][0-9]\b"),
        ("early_20c_1900_1950", None, r"\b19[0-4][0-9]\b"),
        ("classical_pre1900", None, r"\b1[0-8][0-9]{2}\b"),
    ),
}


def rule_fields(rules: Mapping = RULES) -> dict[str, Column]:
    """The default classifier: keyword and pattern rules as columns; name and author are searched."""
    searched = F.lower(F.concat_ws(" ", "name", "author"))

    def test(keyword, pattern):
        return F.array_contains("keywords", keyword) if keyword else searched.rlike(pattern)

    out = {}
    for field, table in rules.items():
        tries = [F.when(test(keyword, pattern), F.lit(value)) for value, keyword, pattern in table]
        out[field] = F.coalesce(*tries, F.lit(ENUM_FALLBACK[field]))
    return out


def classify_by_rules(df: DataFrame) -> DataFrame:
    return df.withColumns(rule_fields())


def embed(df: DataFrame, embedder: Embedder, text_version: str = EMBED_TEXT_VERSION, batch_size: int = EMBED_BATCH) -> DataFrame:
    """(id, embedding, text_version, text_hash) of the (id, text) rows, through any batch embedder.

    The embedder must answer every row of a batch; a failing batch fails its task, which Spark retries.
    """
    schema = T.StructType([df.schema["id"], T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(frames):
        import pandas as pd

        for frame in frames:
            for at in range(0, len(frame), batch_size):
                part = frame.iloc[at : at + batch_size]
                found = embedder(part["text"].tolist())
                if len(found) != len(part):
                    raise ValueError(f"{len(part)} texts but {len(found)} vectors")
                yield pd.DataFrame({"id": part["id"].to_numpy(), "embedding": [list(map(float, v)) for v in found]})

    made = df.select("id", "text").mapInPandas(run, schema)
    stamped = made.withColumn("text_version", F.lit(text_version))
    return stamped.join(df.select("id", text_hash(F.col("text")).alias("text_hash")), "id")


def text_hash(*text: Column) -> Column:
    """Stored with a vector or an answer, so that an edited text under the same id is done again."""
    return F.xxhash64(*text)


def hash_embed(df: DataFrame, dim: int = 256, text_version: str = EMBED_TEXT_VERSION) -> DataFrame:
    """The default embedder: hashed terms, inverse document frequency, length 1; all inside Spark ML."""
    stages = [
        RegexTokenizer(inputCol="text", outputCol="_terms", pattern=r"[^\p{L}]+", minTokenLength=3),
        HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=dim),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_unit"),
    ]
    texts = df.select("id", "text")
    out = Pipeline(stages=stages).fit(texts).transform(texts)
    return out.select(
        "id", vector_to_array("_unit", "float32").alias("embedding"), F.lit(text_version).alias("text_version"),
        text_hash(F.col("text")).alias("text_hash"))


def tfidf_terms(docs: DataFrame) -> DataFrame:
    """(id, term, tf, df, tfidf) with tfidf = tf * ln((N + 1) / (df + 1)); terms are counted before the join.

    Texts are cut once. Both counts are written, so that the planner sees the true size of the vocabulary and leaves the rows where they are if it is small."""
    tf = settle(docs.select("id", F.explode(terms(F.col("text"))).alias("term")).groupBy("id", "term").agg(
        F.count(F.lit(1)).alias("tf")))
    df = settle(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    total = docs.agg(F.count(F.lit(1))).scalar()
    weight = F.col("tf") * F.log((total + 1) / (F.col("df") + 1))
    return tf.join(df, "term").select("id", "term", "tf", "df", weight.alias("tfidf"))
