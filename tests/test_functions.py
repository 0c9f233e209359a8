"""Edge cases of the column functions (FIXTURES.md, edge-case literals)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartlens.functions import parse as ps
from cartlens.functions import (canonical_sex, clean_review_text, clean_str, is_invalid_json,
                                na_to_null, normalize_label, normalize_whitespace, parse_boolean,
                                parse_integer, parse_list_string, parse_ts_coerce, parse_ts_strict)


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_na_tokens(spark):
    out = col_values(spark, ["", " ", '""', "nan", "None", "NA", "x"], na_to_null)
    assert out == [None, None, None, None, None, "NA", "x"]


def test_parse_boolean(spark):
    assert col_values(spark, ["TRUE", "0", "1.0", "false", None], parse_boolean) == [True, False, True, False, None]
    with pytest.raises(Exception):
        col_values(spark, ["yes"], parse_boolean)


def test_parse_integer(spark):
    assert col_values(spark, ["1.0", "7", None], parse_integer) == [1, 7, None]
    with pytest.raises(Exception):
        col_values(spark, ["1.5"], parse_integer)


def test_parse_list_string(spark):
    out = col_values(spark, [None, " ", "[]", "[a, b,]"], parse_list_string)
    assert out == [[], [], [""], ["a", " b", ""]]


def test_clean_str_unicode_whitespace(spark):
    assert col_values(spark, ["  A\t", "   ", None], lambda c: clean_str(c, "lower")) == ["a", None, None]


def test_canonical_sex(spark):
    assert col_values(spark, [" maschio", "Donna", "x", None, "uomo "], canonical_sex) == ["M", "F", None, None, "M"]


def test_coercing_and_strict_timestamps(spark):
    out = col_values(spark, ["2020-01-01", "x", None], parse_ts_coerce)
    assert out == [dt.datetime(2020, 1, 1), None, None]
    with pytest.raises(Exception):
        col_values(spark, ["x"], parse_ts_strict)


def test_whitespace_and_label(spark):
    assert col_values(spark, ["  a \n\t b  ", None], normalize_whitespace) == ["a b", None]
    assert col_values(spark, [" Positive ", "  "], normalize_label) == ["positive", ""]


def test_review_cleaning(spark):
    out = col_values(spark, ["WOW!!! <b>ok</b> http://x.y è...", None, "a ! ! b??"], clean_review_text)
    assert out == ["wow! ok .", "", "a ! ! b?"]


def test_json_validity(spark):
    out = col_values(spark, ['{"a": 1}', '"k": 1}', "", "1, 2", None, "[1]"], is_invalid_json)
    assert out == [False, True, True, True, False, False]


def test_whitespace_set_matches_python_isspace(spark):
    from cartlens.schema import WS_CHARS
    assert WS_CHARS == "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
    s = "\u3000\xa0 a b \x1c"
    assert col_values(spark, [s], lambda c: clean_str(c)) == [s.strip()]


def test_numbers_keep_their_digits_and_reject_suffixes(spark):
    df = spark.createDataFrame([("9007199254740993",), ("12.0",), ("1e3",), ("-7",)], "x string")
    assert [r[0] for r in df.select(ps.parse_integer("x")).collect()] == [9007199254740993, 12, 1000, -7]
    for bad in ("1.5d", "1f", "0x10", "1.5"):
        with pytest.raises(Exception, match="invalid integer"):
            spark.createDataFrame([(bad,)], "x string").select(ps.parse_integer("x")).collect()
    with pytest.raises(Exception, match="invalid number"):
        spark.createDataFrame([("1.5d",)], "x string").select(ps.parse_double("x")).collect()
    assert spark.createDataFrame([("1.5",)], "x string").select(ps.parse_double("x")).first()[0] == 1.5


def test_timestamps_have_one_format_and_no_zone(spark):
    rows = ["2024-03-31 02:30:00", "2024-03-31T02:30:00.5", "2024", "2024-03-31", "2024-03-31 02:30:00+01:00", "x", None]
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Rome")
    try:
        got = [r[0] for r in df.select(ps.parse_ts_coerce("x", ps.ISO_TIME)).collect()]
        either = [r[0] for r in df.select(ps.parse_ts_coerce("x")).collect()]
        dates = [r[0] for r in df.select(ps.parse_ts_coerce("x", "yyyy-MM-dd")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 3, 31, 2, 30, 0, 500000)] + [None] * 5
    assert either == got[:3] + [dt.datetime(2024, 3, 31)] + [None] * 3
    assert dates == [None, None, None, dt.datetime(2024, 3, 31), None, None, None]
