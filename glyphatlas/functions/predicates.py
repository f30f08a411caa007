"""Row predicates shared by selection, sampling and map filters."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphatlas.vocab import EXCLUDE_KEYWORDS, MIN_TERMS_VISIBLE, SEED_KEYWORDS


def has_any(keywords: Column, wanted: tuple[str, ...]) -> Column:
    return F.arrays_overlap(keywords, F.array(*map(F.lit, wanted)))


def exclusion_reasons(bad: tuple[str, ...] = EXCLUDE_KEYWORDS, min_terms: int = MIN_TERMS_VISIBLE) -> dict[str, Column]:
    """Named reasons for leaving a record out; they may overlap."""
    reasons = {f"keyword={k}": F.array_contains("keywords", k) for k in bad}
    reasons[f"n_terms<{min_terms}"] = F.col("n_terms_visible") < min_terms
    reasons["empty name"] = F.length("name") == 0
    return {k: F.coalesce(c, F.lit(False)) for k, c in reasons.items()}


def excluded(bad: tuple[str, ...] = EXCLUDE_KEYWORDS, min_terms: int = MIN_TERMS_VISIBLE) -> Column:
    return reduce(lambda a, b: a | b, exclusion_reasons(bad, min_terms).values())


def is_seed() -> Column:
    return F.coalesce(has_any(F.col("keywords"), SEED_KEYWORDS), F.lit(False))


def any_null(cols: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def facet_match(
    categories: Mapping[str, list[str]],
    ranges: Mapping[str, tuple[float, float, float | None]],
    keywords: list[str] | None = None,
    keyword_col: str = "keywords",
) -> Column:
    """Multi-select categories, any of the chosen keywords, and numeric ranges `(low, high, cap)`.

    A high end that reaches the cap means "cap or more". Once the year range is used, rows without a
    year (0) drop out, because 0 lies below every range.
    """
    tests = [F.col(c).isin(*values) for c, values in categories.items() if values]
    for c, (low, high, cap) in ranges.items():
        tests.append(F.col(c) >= low)
        if cap is None or high < cap:
            tests.append(F.col(c) <= high)
    if keywords:
        tests.append(has_any(F.col(keyword_col), tuple(keywords)))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def contains_text(haystack: Column, query: str) -> Column:
    return F.contains(F.lower(haystack), F.lower(F.lit(query)))
