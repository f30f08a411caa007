import pytest
from pyspark.sql import functions as F

from glyphatlas.functions.predicates import contains_text
from glyphatlas.operators import postings
from glyphatlas.operators.postings import candidates, search_postings, trigrams, write_postings

TEXTS = ["The cat and the hat", "cathat", "CAT  AND", "", None, "ab", "aaaa", "a" * 5000 + "b", "Élan vital élan", "x\n\ny z", "naïve 𝒳𝒴𝒵 sets", "the catalog, hatand"]


def test_trigrams(spark):
    row = spark.createDataFrame([("aB𝒳d",), ("ab",), (None,)], "t string").select(trigrams(F.col("t")).alias("g")).collect()
    assert [[tuple(x) for x in r["g"]] for r in row] == [[(0, "ab𝒳"), (1, "b𝒳d")], [], []]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, "a cat without a key"), (3, "two rows, one key: hat"), (3, "neither")], "id bigint, t string")
    place = str(tmp_path_factory.mktemp("index") / "x")
    write_postings(rows, place, "id", "t", buckets=4)
    return rows, place


@pytest.mark.parametrize("query", ["cat", "Cat and", "hat", "aaa", "aaaa", "aaab", "élan", "ÉLAN V", "\n\ny", "𝒳𝒴𝒵", "b", "ab", "", "no such text", "%_%", "cat  and"])
def test_same_rows_as_the_scan(spark, index, query):
    rows, place = index
    want = [tuple(r) for r in rows.where(contains_text(F.col("t"), query)).collect()]
    got = [tuple(r) for r in search_postings(spark, place, query).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_only_candidates_are_compared(spark, index):
    _, place = index
    assert {r["key"] for r in candidates(spark, place, "the cat").collect()} == {0, 11}
    plan = candidates(spark, place, "the cat")._jdf.queryExecution().toString()
    assert "In(gram" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError):
        candidates(spark, place, "ab")


def test_empty_table(spark, tmp_path):
    write_postings(spark.createDataFrame([], "id string, t string"), str(tmp_path / "x"), "id", "t")
    assert search_postings(spark, str(tmp_path / "x"), "any").count() == 0


def test_packed_places_are_those_of_the_trigrams(spark, index, monkeypatch):
    monkeypatch.setattr(postings, "PIECE", 20)
    rows = index[0].select(F.col("id").alias("key"), F.col("t").alias("text")).where("text IS NOT NULL")
    want = rows.select("key", F.inline(trigrams(F.col("text")))).select("gram", "key", "pos")
    got = postings.packed(rows).select("gram", F.inline(F.arrays_zip("keys", "places")))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_a_gram_is_one_row_of_many_texts(spark, tmp_path):
    rows = spark.range(0, 500, 1, 1).select("id", F.lit("the and " * 20).alias("t"))
    write_postings(rows, str(tmp_path / "x"), "id", "t", buckets=4)
    assert spark.read.parquet(str(tmp_path / "x" / "postings")).count() < 500
    assert search_postings(spark, str(tmp_path / "x"), "The and").count() == 500
