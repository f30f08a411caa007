"""Display strings and numeric channels of map points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphatlas.functions.strings import head, non_empty, split_lines, strip, text_or_empty
from glyphatlas.vocab import FIRST_LINE_CHARS, TAIL_LABELS, UNKNOWN_LABEL

# Characters and what they become in HTML; the ampersand comes first.
HTML_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))


def html_escape(c: Column) -> Column:
    out = text_or_empty(c)
    for char, entity in HTML_ESCAPES:
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def first_line(c: Column, limit: int = FIRST_LINE_CHARS) -> Column:
    """First non-blank line, shortened with an ellipsis; empty when there is none."""
    line = F.coalesce(F.get(non_empty(F.transform(split_lines(c), strip)), F.lit(0)), F.lit(""))
    short = F.regexp_replace(head(line, limit - 1), r"(?U)[\s\x1C-\x1F]+$", "")
    return F.when(F.length(line) <= limit, line).otherwise(F.concat(short, F.lit("…")))


def clean_author(c: Column) -> Column:
    """Primary author: the leading underscore-wrapped name, else the text before `and`, a comma or a bracket."""
    wrapped = F.regexp_extract(c, r"^_([^_]+)_", 1)
    plain = F.get(F.split(c, r"(?U)\s+and\s+|,|\(", 2), F.lit(0))
    return F.when(c.isNull(), "").otherwise(strip(F.when(wrapped != "", wrapped).otherwise(plain)))


def join_keywords(c: Column, separator: str = ", ") -> Column:
    return F.array_join(non_empty(F.coalesce(c, F.array().cast("array<string>"))), separator)


def int_or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("bigint")


def year_or_zero(c: Column) -> Column:
    return F.coalesce(F.year(c), F.lit(0)).cast("bigint")


def label_or_unknown(c: Column) -> Column:
    return F.coalesce(c, F.lit(UNKNOWN_LABEL))


def log_edits(c: Column) -> Column:
    return F.log10(F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)).cast("double"))


def log_references(c: Column) -> Column:
    return F.log10(F.coalesce(c, F.lit(0)).cast("double") + 1)


def tail_rank(c: Column) -> Column:
    """0 for ordinary values, then the pinned-last labels in their own order."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, TAIL_LABELS)), c), F.lit(0)).cast("bigint")
