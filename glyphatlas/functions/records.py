"""Column expressions that turn one tagged text into the fields of a record.

A tagged line reads `%<code> A<digits> <content>`. Nothing here shuffles or leaves the JVM: the lines of a
text stay an array of structs, and every field is a filter over that array.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphatlas.functions.strings import ANY_BREAK, BLANK, let, non_empty, strip
from glyphatlas.vocab import LANGUAGE_BUCKETS, MAX_VALUES_SHOWN, MONTHS, OTHER_LANGUAGE

_TAGGED = rf"(?U)^%\w{BLANK}+A\d+(?={BLANK}|$)"
_PREFIX = rf"(?U)^%\w{BLANK}+A\d+{BLANK}?"
_HEADER = rf"(?U)^%I{BLANK}+(A\d+)(?:{BLANK}+M\d+{BLANK}+N\d+)?{BLANK}+#(\d+){BLANK}+(.+?){BLANK}*$"
_LANG_TAG = r"^\(([A-Za-z][A-Za-z0-9/+#. -]{0,28})\)"
_INTEGER = r"^[+-]?[0-9]+$"
_CLOCK = r"^\+?[0-9]+$"


def tagged_lines(text: Column) -> Column:
    """array<struct<field, content, line>> of the well-formed tagged lines, in text order.

    The patterns stop after the prefix, so that the content of a line is never scanned by them.
    """
    kept = F.filter(F.split(text, ANY_BREAK), lambda x: x.startswith("%") & x.rlike(_TAGGED))
    return F.transform(
        kept,
        lambda x: F.struct(
            F.substring(x, 2, 1).alias("field"), F.regexp_replace(x, _PREFIX, "").alias("content"), x.alias("line")
        ),
    )


def field_contents(lines: Column, *codes: str) -> Column:
    return F.transform(F.filter(lines, lambda x: x["field"].isin(*codes)), lambda x: x["content"])


def first_non_empty(parts: Column) -> Column:
    return F.coalesce(F.get(non_empty(F.transform(parts, strip)), F.lit(0)), F.lit(""))


def parse_edit_date(c: Column) -> Column:
    """`Mon DD YYYY hh:mm:ss` as a zone-free timestamp; null for anything else."""
    return let(F.split(strip(c), f"(?U){BLANK}+"), lambda parts: let(
        F.split(F.get(parts, F.lit(3)), ":"), lambda clock: _timestamp(parts, clock)))


def _timestamp(parts: Column, clock: Column) -> Column:
    number = lambda x: F.when(x.rlike(_CLOCK), x.try_cast("int"))
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.get(parts, F.lit(0))).cast("int")
    hour, minute, second = (number(F.get(clock, F.lit(i))) for i in range(3))
    year = number(F.get(parts, F.lit(2)))
    shape = (F.size(parts) == 4) & (F.size(clock) == 3) & (month > 0) & (second < 60) & year.between(1, 9999)
    stamp = F.try_make_timestamp_ntz(year, month, number(F.get(parts, F.lit(1))), hour, minute, second)
    return F.when(shape, stamp)


def parse_header(lines: Column) -> Column:
    """struct<id, edits, stamp> of the last well-formed header line; null where there is none."""
    heads = F.filter(lines, lambda x: (x["field"] == "I") & x["line"].rlike(_HEADER))
    return let(F.try_element_at(heads, F.lit(-1))["line"], lambda last: F.when(
        last.isNotNull(),
        F.struct(
            F.regexp_extract(last, _HEADER, 1).alias("id"),
            F.regexp_extract(last, _HEADER, 2).try_cast("bigint").alias("edits"),
            parse_edit_date(F.regexp_extract(last, _HEADER, 3)).alias("stamp"),
        ),
    ))


def lang_tag(c: Column) -> Column:
    """The language tag in brackets at the start of a code line; null where it is code, not a tag."""
    return let(F.regexp_extract(strip(c), _LANG_TAG, 1), lambda tag: F.when(tag != "", tag))


def lang_bucket(tag: Column) -> Column:
    """Lower-case, single-spaced, without a trailing version number, looked up; `other` if unknown."""
    clean = F.regexp_replace(F.lower(strip(tag)), f"(?U){BLANK}+", " ")
    clean = F.regexp_replace(clean, r" \d+(\.\d+)?$", "")
    table = F.create_map(*[F.lit(x) for pair in LANGUAGE_BUCKETS.items() for x in pair])
    return F.when(tag.isNotNull(), F.coalesce(F.try_element_at(table, clean), F.lit(OTHER_LANGUAGE)))


def code_languages(lines: Column) -> Column:
    """Sorted distinct buckets; two line codes name their language themselves."""
    tags = F.filter(F.transform(field_contents(lines, "o"), lang_tag), lambda t: t.isNotNull())
    none = F.array().cast("array<string>")
    has = lambda code: F.exists(lines, lambda x: x["field"] == code)
    return F.array_sort(
        F.array_distinct(
            F.concat(
                F.when(has("p"), F.array(F.lit("maple"))).otherwise(none),
                F.when(has("t"), F.array(F.lit("mathematica"))).otherwise(none),
                F.transform(tags, lang_bucket),
            )
        )
    )


def keyword_list(c: Column) -> Column:
    return non_empty(F.transform(F.split(c, ","), strip))


def value_terms(chunks: Column) -> Column:
    """Terms of all value chunks in text order: trailing commas dropped, terms trimmed, blanks dropped."""
    closed = F.transform(non_empty(F.transform(chunks, strip)), lambda x: F.regexp_replace(x, ",+$", ""))
    return non_empty(F.transform(F.split(F.array_join(closed, ","), ","), strip))


def int64_prefix(terms: Column, limit: int = MAX_VALUES_SHOWN) -> Column:
    """Leading terms that are 64-bit integers; stops at the first that is not."""
    typed = F.transform(F.slice(terms, 1, limit), lambda t: F.when(t.rlike(_INTEGER), t.try_cast("bigint")))
    bad = lambda ts: F.array_position(F.transform(ts, lambda t: t.isNull()), True).cast("int")
    return let(typed, lambda ts: let(bad(ts), lambda b: F.when(b == 0, ts).otherwise(
        F.slice(ts, F.lit(1), F.greatest(b - 1, F.lit(0))))))


def values_preview(terms: Column, limit: int = MAX_VALUES_SHOWN) -> Column:
    more = F.when(F.size(terms) > limit, F.lit(", …")).otherwise(F.lit(""))
    return F.concat(F.array_join(F.slice(terms, 1, limit), ", "), more)


def has_bfile(lines: Column) -> Column:
    """True if a link line names the value file of the id known at that point of the text."""

    def step(state: Column, x: Column) -> Column:
        seen = F.regexp_extract(x["line"], _HEADER, 1)
        known = F.when((x["field"] == "I") & (seen != ""), seen).otherwise(state["id"])
        digits = F.substr(state["id"], F.lit(2))
        link = F.concat(F.lit('href="/'), state["id"], F.lit("/b"), digits, F.lit('.txt"'))
        hit = state["hit"] | ((x["field"] == "H") & (state["id"] != "") & x["content"].contains(link))
        return F.struct(known.alias("id"), hit.alias("hit"))

    relevant = F.filter(lines, lambda x: x["field"].isin("I", "H"))
    return F.aggregate(
        relevant, F.struct(F.lit("").alias("id"), F.lit(False).alias("hit")), step, lambda state: state["hit"]
    )


def count_field(lines: Column, code: str) -> Column:
    return F.size(F.filter(lines, lambda x: x["field"] == code)).cast("bigint")


def file_stem(path: Column) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
