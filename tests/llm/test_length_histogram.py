from glyphatlas.llm import length_histogram as lh
from tests.llm.cases import empty, messy, messy_rows
from tests.llm.test_token_codes import library_ids


def test_matches_brute_force(spark):
    lengths = [len(library_ids(r[1])) for r in messy_rows()]
    histogram = lh.length_histogram(lh.encoded_lengths(messy(spark)))
    assert {r["length"]: r["n_docs"] for r in histogram.collect()} == {n: lengths.count(n) for n in lengths}
    curve = lh.suffix_sums(histogram)
    rows = curve.collect()
    assert len(rows) == len(set(lengths))
    for r in rows:
        limit = r["length"]
        assert r["docs_longer"] == sum(n > limit for n in lengths) and r["tokens_longer"] == sum(n for n in lengths if n > limit)
        assert r["truncated_total"] == sum(min(n, limit) for n in lengths) and r["lost_total"] == sum(max(0, n - limit) for n in lengths)
        assert r["docs_upto"] + r["docs_longer"] == r["total_docs"] == len(lengths) and r["tokens_upto"] + r["tokens_longer"] == r["total_tokens"] == sum(lengths)
        assert r["quantile"] == r["docs_upto"] / len(lengths)
    for q in (0.1, 0.5, 1.0):
        want = min(n for n in lengths if sum(m <= n for m in lengths) >= q * len(lengths))
        assert lh.length_at_quantile(curve, q).first()[0] == want
    for r in lh.at_limits(histogram, [0, 7, 100, 100_000]).collect():
        assert r["truncated_total"] == sum(min(n, r["context_limit"]) for n in lengths)
        assert r["docs_upto"] == sum(n <= r["context_limit"] for n in lengths)


def test_empty_table(spark):
    assert lh.suffix_sums(lh.length_histogram(lh.encoded_lengths(empty(spark)))).count() == 0
