"""Column functions on hand-made rows (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from larder.functions import dates as D
from larder.functions.nested import name_with_fallback, struct_lookup
from larder.functions.predicates import allow_or_null, cap_filter, not_in_nonnull, out_of_range
from larder.functions.text import first_of_list, prettify_tag, sentence_case, tag_name_offset

NUT = "array<struct<name:string,`100g`:double>>"
NAMES = "array<struct<lang:string,text:string>>"


def test_brand_name_cases(spark):
    df = spark.createDataFrame([(" Nutella , Ferrero",), ("",), (None,), (" , x",)], "brands string")
    rows = df.select(F.trim(first_of_list("brands")).alias("raw")).select(
        sentence_case("raw").alias("a"), F.upper("raw").alias("b")).collect()
    assert [tuple(r) for r in rows] == [("Nutella", "NUTELLA"), ("", ""), (None, None), ("", "")]


def test_tag_names(spark):
    df = spark.createDataFrame([("en:united-states",), ("fra:cafe",), ("en",)], "t string")
    rows = df.select(prettify_tag("t").alias("p"), tag_name_offset("t").alias("o")).collect()
    assert [tuple(r) for r in rows] == [("United States", "United-states"), ("Fra:cafe", ":cafe"), ("En", "")]


def test_struct_lookup_edge_cases(spark):
    df = spark.createDataFrame(
        [([{"name": "fat", "100g": 1.0}],), ([],), (None,),
         ([{"name": "salt", "100g": 0.5}, {"name": "salt", "100g": 0.9}],)], f"n {NUT}")
    got = [r[0] for r in df.select(struct_lookup("n", "name", "salt", "100g")).collect()]
    assert got == [None, None, None, 0.5]


def test_name_with_language_fallback(spark):
    df = spark.createDataFrame(
        [([{"lang": "fr", "text": "Pain"}],), ([{"lang": "en", "text": "A"}, {"lang": "main", "text": "B"}],),
         ([],), (None,)], f"p {NAMES}")
    assert [r[0] for r in df.select(name_with_fallback("p")).collect()] == ["Pain", "B", None, None]


def test_weekdays_and_weekend(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)], "d date")
    rows = df.select(D.iso_weekday("d"), D.sunday_weekday("d"), D.is_weekend("d")).collect()
    assert [tuple(r) for r in rows] == [(6, 7, True), (7, 1, True), (1, 2, False)]


def test_seconds_to_date_and_key(spark):
    df = spark.createDataFrame([(1718000000,), (None,), (-1,)], "t bigint")
    rows = df.select(D.seconds_to_date("t").alias("d")).select("d", D.date_key("d"), D.decade("d"),
                                                               D.month_name("d")).collect()
    assert tuple(rows[0]) == (dt.date(2024, 6, 10), 20240610, 2020, "Juin")
    assert tuple(rows[1]) == (None, None, None, None)
    assert rows[2][0] == dt.date(1969, 12, 31)


def test_session_zone_does_not_move_dates(spark):
    df = spark.createDataFrame([(1717977600 + 82799,)], "t bigint")  # 2024-06-10 22:59:59 UTC
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert df.select(D.seconds_to_date("t")).first()[0] == dt.date(2024, 6, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_grade_allow_list_and_filters(spark):
    df = spark.createDataFrame([("unknown",), ("A",), (None,), ("a",)], "g string")
    assert [r[0] for r in df.select(allow_or_null("g", list("abcde"))).collect()] == [None, None, None, "a"]
    e = spark.createDataFrame([(None,), (900.0,), (901.0,)], "e double")
    assert [r[0] for r in e.filter(cap_filter("e", 900)).collect()] == [900.0]
    s = spark.createDataFrame([(-16,), (-15,), (40,), (41,), (None,)], "s int")
    assert s.filter(out_of_range("s", -15, 40)).count() == 2
    assert df.filter(not_in_nonnull("g", list("abcde"))).count() == 2
