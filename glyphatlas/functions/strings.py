"""Whitespace rules shared by every parser: Unicode blanks, not only the space that `trim` knows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\s\x1C-\x1F]"
# CR LF, or one of LF VT FF CR FS GS RS NEL LS PS.
LINE_BREAK = "\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]"
# The same, where a CR LF may count as two breaks because blank lines do not matter.
ANY_BREAK = "[\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)^{BLANK}+|{BLANK}+$", "")


def split_lines(c: Column) -> Column:
    return F.split(c, LINE_BREAK)


def non_empty(parts: Column) -> Column:
    return F.filter(parts, lambda p: p != "")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def head(c: Column, n: int) -> Column:
    """The first `n` characters (code points)."""
    return F.substring(c, 1, n)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` worked out once, however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
