import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from glyphatlas.llm import exact_dedup
from tests.llm.cases import empty, messy, messy_rows, prose, texts


def brute(rows):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[low(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[low(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(low(t).encode()).hexdigest()))
    return ordered(out)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def rows_of(df):
    return ordered([tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()])


CASES = [(1, "Ärger"), (2, "ärger"), (3, "ÄRGER"), (4, "Ärger"), (5, "a"), (6, "A"), (7, "A "), (8, None), (9, ""), (None, "a"), (None, ""), (10, "İ"), (11, "i̇"), (5, "a")]


@pytest.mark.parametrize("digest", [F.xxhash64, lambda t: F.length(t).cast("long"), lambda t: F.lit(1).cast("long")])
@pytest.mark.parametrize("partitions", [1, 7])
def test_texts_that_share_a_digest_stay_apart(spark, digest, partitions):
    assert rows_of(exact_dedup.duplicates(texts(spark, CASES).repartition(partitions), digest)) == brute(CASES)


def test_messy_rows_and_clashing_columns(spark):
    docs = messy(spark).withColumns({c: F.lit(1) for c in ("digest", "salt", "top", "n", "keep_id", "group_size", "kept", "text_sha256", "texts")})
    assert rows_of(exact_dedup.duplicates(docs)) == brute([r[:2] for r in messy_rows()])


def test_a_group_with_a_third_of_all_rows_and_many_small_ones(spark):
    rows = [(i, "The Same Text" if i % 3 == 0 else prose(i % 1500, 3)) for i in range(3000)]
    assert rows_of(exact_dedup.duplicates(texts(spark, rows).repartition(16))) == brute(rows)


def test_kept_rows_are_one_of_each_text(spark):
    rows = exact_dedup.kept_rows(messy(spark)).collect()
    want = {(r[0], r[4]) for r in brute([r[:2] for r in messy_rows()]) if r[3]}
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    got = [(r["doc_id"], hashlib.sha256(low(r["text"]).encode()).hexdigest()) for r in rows]
    assert len(got) == len(set(got)) and set(got) == want
    assert rows[0].asDict().keys() == messy(spark).limit(1).collect()[0].asDict().keys()


def test_native(spark):
    plan = exact_dedup.duplicates(messy(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert exact_dedup.duplicates(empty(spark)).count() == 0
    assert exact_dedup.kept_rows(empty(spark)).count() == 0
