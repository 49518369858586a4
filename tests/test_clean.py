"""Cleaning functions on the hand-made edge values of FIXTURES.md §4."""

import datetime as dt
import math

from pyspark.sql import functions as F

from peerscore.functions import clean


def test_safe_cast_edges(spark):
    vals = ["--", "", "1,234", " 7 ", "12.5", "nan", "abc", None, "3"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = df.select(clean.safe_cast("x").alias("d"), clean.safe_cast("x", "int").alias("i")).collect()
    d = [r.d for r in got]
    i = [r.i for r in got]
    assert d[:5] == [0.0, 0.0, 0.0, 7.0, 12.5] and math.isnan(d[5]) and d[6:] == [0.0, 0.0, 3.0]
    assert i == [0, 0, 0, 7, 0, 0, 0, 0, 3]


def test_clean_number_and_rating(spark):
    df = spark.createDataFrame([("1,234", "4 star"), ("--", None), ("12,345.5", "x star")], "n string, r string")
    got = df.select(clean.clean_number("n", "int").alias("n"), clean.clean_number("n").alias("d"),
                    clean.parse_rating("r").alias("r")).collect()
    assert [(g.n, g.d, g.r) for g in got] == [(1234, 1234.0, 4), (0, 0.0, 0), (0, 12345.5, 0)]


def test_labels_and_names(spark):
    df = spark.createDataFrame([("A1+",), ("A and Below",), ("Cash Equivalent",), ("x/y",)], "l string")
    assert [r.n for r in df.select(clean.normalize_label("l").alias("n")).collect()] == [
        "a1plus", "a_and_below", "cash_equivalent", "xandy"]
    df2 = spark.createDataFrame([("  Acme Asset. -- Co!! ",)], "s string")
    assert df2.select(clean.normalize_name("s").alias("n")).first().n == "Acme Asset Co"


def test_url_functions(spark):
    df = spark.createDataFrame([("/subjects/3389/some-name", "https://www.example.com:8080/search?q=1")], "p string, u string")
    r = df.select(clean.url_segment("p", 2).alias("id"), clean.url_segment("p", 9).alias("none"),
                  clean.absolute_url("u", "p").alias("abs")).first()
    assert r.id == "3389" and r.none is None and r.abs == "https://www.example.com:8080/subjects/3389/some-name"


def test_arrays(spark):
    df = spark.createDataFrame([([" a ", "", "  ", "b", " c"],)], "a array<string>")
    r = df.select(clean.compact_array("a").alias("c"), clean.array_get_default("a", 9).alias("d"),
                  clean.array_head("a", 2).alias("h"), clean.to_json_text("a").alias("j")).first()
    assert r.c == ["a", "b", "c"] and r.d == "0" and r.h == [" a ", ""] and r.j.startswith('[" a "')


def test_defaults_and_dates(spark):
    df = spark.createDataFrame([(None, None, dt.date(2023, 1, 6))], "s string, n double, d date")
    r = df.select(clean.default_missing("s", "").alias("s"), clean.default_missing("n", 0.0).alias("n"),
                  clean.format_date("d", "%d-%m-%Y").alias("f"), clean.format_date("d").alias("iso")).first()
    assert (r.s, r.n, r.f, r.iso) == ("", 0.0, "06-01-2023", "2023-01-06")
    r2 = df.select(clean.default_missing(F.lit(None).cast("array<string>"), []).alias("a")).first()
    assert r2.a == []


def test_safe_cast_checks_the_text(spark):
    from peerscore.functions.clean import out_of_range, safe_cast

    rows = ["12d", "5f", "0x1A", "1e3", " 7 ", "-.5", "12.", "1,2", "--", None, "12.5"]
    df = spark.createDataFrame([(x,) for x in rows], "x string")
    got = [r[0] for r in df.select(safe_cast("x")).collect()]
    assert got == [0.0, 0.0, 0.0, 1000.0, 7.0, -0.5, 12.0, 0.0, 0.0, 0.0, 12.5]
    ints = [r[0] for r in df.select(safe_cast("x", "bigint")).collect()]
    assert ints == [0, 0, 0, 0, 7, 0, 0, 0, 0, 0, 0]
    big = spark.createDataFrame([("9,223,372,036,854,775,808",), ("12",), (None,), ("x",)], "x string")
    assert [r[0] for r in big.select(out_of_range("x", "bigint")).collect()] == [True, False, False, False]
