"""Parsing of tagged texts, on texts written for these tests."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from glyphatlas.functions import records as R
from glyphatlas.operators.graph import cached_edges, canonical, edge_cache, extract_edges
from glyphatlas.operators.records import tagged_lines, tagged_records


@pytest.fixture(scope="module")
def parse(spark):
    def run(*lines, path="x/a000123.seq", sep="\n"):
        df = spark.createDataFrame([(path, sep.join(lines))], "path string, text string")
        return tagged_records(df).first()

    return run


HEAD = "%I A000123 #7 Feb 03 2021 04:05:06"


def test_header_forms(parse):
    assert parse(HEAD)["edit_count"] == 7
    r = parse("%I A000123 M0098 N0035 #326 Jan 28 2026 13:29:57")
    assert (r["id"], r["edit_count"], r["last_edited"]) == ("A000123", 326, datetime(2026, 1, 28, 13, 29, 57))


def test_broken_header_falls_back_to_file_name(parse):
    r = parse("%I A000999 M0098 #5 Jan 28 2026 13:29:57", '%H A000999 <a href="/A000999/b000999.txt">x</a>')
    assert (r["id"], r["edit_count"], r["last_edited"], r["has_bfile"], r["n_links"]) == ("A000123", 0, None, False, 1)


def test_last_header_wins_and_link_check_sees_the_id_so_far(parse):
    link = '%H A000001 <a href="/A000001/b000001.txt">x</a>'
    r = parse("%I A000001 #1 Jan 01 2020 00:00:00", link, "%I A000002 #2 Jan 02 2020 00:00:00")
    assert (r["id"], r["edit_count"], r["has_bfile"]) == ("A000002", 2, True)
    assert not parse(link, "%I A000001 #1 Jan 01 2020 00:00:00")["has_bfile"]


@pytest.mark.parametrize("text,want", [
    ("Jul 08 2022 12:19:01", datetime(2022, 7, 8, 12, 19, 1)),
    ("Jul 08 2022 12:19:60", None),
    ("jul 08 2022 12:19:01", None),
    ("Feb 30 2022 12:19:01", None),
    ("Foo 99 2026 99:99:99", None),
    ("Jul 08 2022", None),
    ("", None),
])
def test_dates(spark, text, want):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(R.parse_edit_date(F.col("s"))).first()[0] == want


@pytest.mark.parametrize("text,tag,bucket", [
    ("(PARI) a(n) = 2*n", "PARI", "pari"),
    ("(Python 3)", "Python 3", "python"),
    ("(PARI/GP) x", "PARI/GP", "pari"),
    ("(C++) int a", "C++", "c"),
    ("(C#) x", "C#", "csharp"),
    ("(SageMath 9.2) x", "SageMath 9.2", "sage"),
    ("(Common  Lisp) x", "Common  Lisp", "lisp"),
    ("(Brainfuck) x", "Brainfuck", "other"),
    ("(zipWith (- 1) x)", None, None),
    ("(define (swap! s", None, None),
    ("(1..n)", None, None),
    ("(unclosed", None, None),
    ("def a(n): return 0", None, None),
    ("(" + "a" * 29 + ") x", "a" * 29, "other"),
    ("(" + "a" * 30 + ") x", None, None),
])
def test_language_tags(spark, text, tag, bucket):
    df = spark.createDataFrame([(text,)], "s string").select(R.lang_tag(F.col("s")).alias("t"))
    assert tuple(df.select("t", R.lang_bucket(F.col("t"))).first()) == (tag, bucket)


def test_values(parse):
    r = parse(HEAD, "%S A000123 1,2,,,", "%T A000123  3, 99999999999999999999 ,5", "%V A000123 -6,")
    assert (r["n_terms_visible"], r["values"]) == (6, [1, 2, 3])
    assert r["values_preview_str"] == "1, 2, 3, 99999999999999999999, 5, -6"
    assert parse(HEAD, "%S A000123 x,2")["values"] == []
    assert parse(HEAD)["values_preview_str"] == "" and parse(HEAD)["values"] == []
    long = parse(HEAD, "%S A000123 " + ",".join(map(str, range(20))))
    assert long["values"] == list(range(15)) and long["values_preview_str"].endswith("14, …")
    assert parse(HEAD, "%S A000123 9223372036854775807,9223372036854775808")["values"] == [9223372036854775807]


def test_first_non_empty_wins(parse):
    r = parse(HEAD, "%N A000123", "%N A000123    ", "%N A000123  first  ", "%N A000123 second",
              "%K A000123 , ,", "%K A000123 nonn, core,,easy ", "%K A000123 dead", "%O A000123 1,2", "%O A000123 9",
              "%A A000123 ", "%A A000123 _Ann_")
    assert (r["name"], r["keywords"], r["offset"], r["author"]) == ("first", ["nonn", "core", "easy"], "1,2", "_Ann_")


def test_text_fields_keep_leading_blanks(parse):
    r = parse(HEAD, "%C A000123 one", "%C A000123   two ", "%C A000123", "%F A000123 f", "%e A000123  e")
    assert (r["comments"], r["formulas"], r["examples"]) == ("one\n  two \n", "f", " e")


def test_languages_and_counts(parse):
    r = parse(HEAD, "%p A000123 x", "%t A000123 y", "%o A000123 (Python) x", "%o A000123 (define (x", "%o A000123   (GAP) z",
              "%D A000123 d", "%D A000123", "%H A000123 h", "%E A000123 e")
    assert r["code_languages"] == ["gap", "maple", "mathematica", "python"]
    assert (r["n_references"], r["n_links"], r["n_extensions"]) == (2, 1, 1)


@pytest.mark.parametrize("sep", ["\n", "\r\n", "\r", "\x0b", "\x1c", "\x85", "\u2028"])
def test_line_breaks(parse, sep):
    assert parse(HEAD, "%N A000123 n", "%C A000123 c", sep=sep)["comments"] == "c"


def test_malformed_lines_are_skipped(spark):
    text = "\n".join(["note", "%N", "%N B000001 x", "%NN A000001 x", "%N A000001x y", "%N A000001\ty", "%C A000001 ok"])
    rows = tagged_lines(spark.createDataFrame([("p", text)], "path string, text string")).collect()
    assert [(r["line_no"], r["field"], r["content"]) for r in rows] == [(0, "N", "y"), (1, "C", "ok")]


def test_edges(spark):
    text = "\n".join(["%Y A000001 Cf. A000002, A000001 (this), A0000034.", "%Y A000001", "%C A000001 A000009",
                      "%Y A000002 A000001 and A000002"])
    df = spark.createDataFrame([("p", 1.0, 2, text)], "path string, mtime double, size bigint, text string")
    want = [("A000001", "A000002"), ("A000001", "A000003"), ("A000002", "A000001")]
    assert sorted(map(tuple, extract_edges(df).collect())) == want
    assert sorted(map(tuple, cached_edges(edge_cache(df)).collect())) == want
    assert sorted(map(tuple, canonical(extract_edges(df)).collect())) == [("A000001", "A000002"), ("A000001", "A000003")]
