"""Unit goldens for the scalar functions (FIXTURES §5)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from listing_engine.functions import scalars as S


def _eval(spark, fn, values):
    """Evaluate fn over JSON literals wrapped as {"x": value}."""
    rows = [(i, json.dumps({"x": v}, ensure_ascii=False) if v is not ... else "{}") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, data string")
    m = S.payload(F.col("data"))
    out = df.select("i", fn(m["x"]).alias("r")).orderBy("i").collect()
    return [r.r for r in out]


def test_digits_int(spark):
    vals = [8000, "8,000", "8000.00", "-5", "9.8万", "１２", "²", "abc", "", 0, "0", 8000.9, [1], True, -5.5, "1" * 40]
    exp = [8000, 8000, 800000, 5, 98, 12, None, None, None, None, 0, 8000, None, 1, -5, 1.1111111111111111e39]
    assert _eval(spark, S.digits_int, vals) == exp


def test_digits_float(spark):
    vals = ["1.5L", "1.5.2", ".", 1.4, 0, "2", "²"]
    exp = [1.5, None, None, 1.4, None, 2.0, None]
    assert _eval(spark, S.digits_float, vals) == exp


def test_flex_date(spark):
    vals = ["2019-02", "2025-04-13", "2025-4-3", "2019-13", "2025-02-30", "2025-04-13T00:00", 20190201, ""]
    exp = [dt.date(2019, 2, 1), dt.date(2025, 4, 13), dt.date(2025, 4, 3), None, None, None, None, None]
    assert _eval(spark, S.flex_date, vals) == exp


def test_image_list(spark):
    vals = [["a"], "[\"a\"]", "x", None, 5, [], "{\"a\":1}"]
    exp = [["a"], ["a"], [], [], [], [], []]
    assert _eval(spark, S.image_list, vals) == exp


def test_has_han(spark):
    df = spark.createDataFrame([(0, "大通"), (1, "OTA升级"), (2, "Седан"), (3, None), (4, "㐀")], "i int, t string")
    got = [r.r for r in df.select("i", S.has_han("t").alias("r")).orderBy("i").collect()]
    assert got == [True, True, False, False, False]


def test_priority(spark):
    df = spark.createDataFrame([("mark", 10), ("mark", 9), ("color", 50), ("color", 10), ("color", 9)], "f string, n int")
    got = [r.p for r in df.select(S.priority(F.col("f"), F.col("n")).alias("p")).collect()]
    assert got == ["high", "medium", "medium", "medium", "low"]


def test_falsy(spark):
    vals = [None, "", 0, 0.0, False, [], {}, "0", 0.5, [0], {"a": None}, True]
    exp = [True, True, True, True, True, True, True, False, False, False, False, False]
    assert _eval(spark, S.falsy, vals) == exp


def test_guarded_text(spark):
    vals = ["大通", "", None, 5, 0]
    assert _eval(spark, S.guarded_text, vals) == ["大通", None, None, "5", None]


def test_merge_golden(spark):
    df = spark.createDataFrame([('{"price":8000,"mark":"Kia","year":2020}', '{"new_price":7500}')], "a string, b string")
    got = df.select(F.to_json(S.merge_payload(S.payload(F.col("a")), S.payload(F.col("b")))).alias("j")).first().j
    assert json.loads(got) == {"price": 7500, "mark": "Kia", "year": 2020}
    assert got == '{"price":7500,"mark":"Kia","year":2020}'


@pytest.mark.parametrize("payload,expected", [
    ('{"new_price":1,"price":2}', {"price": 2}),
    ('{"price":2,"new_price":1}', {"price": 1}),
    ('{"a":1,"a":2}', {"a": 2}),
])
def test_new_keys_and_duplicates(spark, payload, expected):
    df = spark.createDataFrame([(payload,)], "a string")
    got = df.select(F.to_json(S.map_new_keys(S.payload(F.col("a")))).alias("j")).first().j
    assert json.loads(got) == expected


def test_event_time(spark):
    now = dt.datetime(2026, 1, 2, 3, 4, 5)
    rows = [(0, "2024-01-01T10:00:00+03:00"), (1, "2024-01-01T10:00:00Z"), (2, "2024-01-01T10:00:00"),
            (3, "bad"), (4, None), (5, "2024-01-01")]
    df = spark.createDataFrame(rows, "i int, s string")
    got = [r.t for r in df.select("i", S.event_time(F.col("s"), now).alias("t")).orderBy("i").collect()]
    assert got == [dt.datetime(2024, 1, 1, 7), dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10), now, now,
                   dt.datetime(2024, 1, 1)]


def test_entry_error_and_accept(spark):
    rows = [("大通", "Maxus"), ("", "x"), ("大通", ""), ("abc", "x"), ("大通", None)]
    df = spark.createDataFrame(rows, "cn string, ru string")
    got = [r.e for r in df.select(S.entry_error(F.col("cn"), F.col("ru")).alias("e")).collect()]
    assert got == [None, "empty_cn", "empty_ru", "cn_without_han", "empty_ru"]
    rows = [("mark", "大通", "Maxus"), ("mark", "大通", "大通"), ("address", "北京", "北京"), ("mark", "大通", "  "),
            ("mark", "大通", "大通X")]
    df = spark.createDataFrame(rows, "f string, cn string, ru string")
    got = [r.a for r in df.select(S.accept_translation(F.col("f"), F.col("cn"), F.col("ru")).alias("a")).collect()]
    assert got == [True, False, True, False, True]
