"""Golden rows of the column functions."""

import datetime

import pytest
from pyspark.sql import functions as F

from hemline.functions import dates, lookups
from hemline.functions.phone import add_dial_code, clean_phone, phone_shape
from hemline.functions.text import (
    default_nulls, has_chinese, lookup_or_keep, replace_within, standardize, strip_titles,
)


def run(spark, fn, values):
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    width = len(rows[0]) - 1
    schema = "i int, " + ", ".join(f"c{k} string" for k in range(width))
    df = spark.createDataFrame(rows, schema)
    out = df.select("i", fn(*[F.col(f"c{k}") for k in range(width)]).alias("y")).orderBy("i")
    return [r.y for r in out.collect()]


def test_standardize(spark):
    raw = ["  children(1-14 YEARS) ", "Suzhou (Jiangsu)", "T-SHIRTS AND polos", "XI'AN", None]
    assert run(spark, standardize, raw) == [
        "Children(1-14 Years)", "Suzhou (jiangsu)", "T-shirts And Polos", "Xi'an", None]


def test_standardize_twice_equals_once(spark):
    raw = [" a  B c", "ÉCOLE élan", "x-Y z"]
    once = run(spark, standardize, raw)
    assert run(spark, standardize, once) == once


def test_titles(spark):
    raw = ["Dr. Ann Lee", "Ann Lee MD", "Mdina Cruz", "Univ.Prof. Dipl.-Ing. Max M",
           "Ann Lee B.Sc.", "Dr.Dr. Ann", "Ing. Bob", "Mrs. Dr. X DVM", None]
    assert run(spark, strip_titles, raw) == [
        "Ann Lee", "Ann Lee", "ina Cruz", "Max M", "Ann Lee", "Ann", "Bob", "X", None]
    strict = run(spark, lambda c: strip_titles(c, strict=True), raw)
    assert strict[2] == "Mdina Cruz" and strict[1] == "Ann Lee" and strict[7] == "X"


def test_dictionaries(spark):
    assert len(lookups.CITY_NAMES) == 105 and len(lookups.COUNTRY_NAMES) == 3
    cities = run(spark, lambda c: lookup_or_keep(c, lookups.CITY_NAMES),
                 ["西安", "苏州（江苏省）", "Frankfurt am Main", "Paris", None])
    assert cities == ["Xi'an", "Suzhou (Jiangsu)", "frankfurt", "Paris", None]
    names = run(spark, lambda c: replace_within(c, lookups.CITY_NAMES),
                ["Store 上海店", "苏州（江苏省）店", "张家口 张家港", "none", None])
    assert names == ["Store Shanghai店", "Suzhou（江苏省）店", "Zhangjiakou Zhangjiagang", "none", None]


def test_every_dictionary_entry(spark):
    keys = list(lookups.CITY_NAMES)
    assert run(spark, lambda c: lookup_or_keep(c, lookups.CITY_NAMES), keys) == [
        lookups.CITY_NAMES[k] for k in keys]


@pytest.mark.parametrize("phone,country,expected", [
    ("(555) 123-4567x890", "United States", "+15551234567"),
    ("001-555-123-4567x12", "United States", "+15551234567"),
    ("1-555-1234567", "United States", "+15551234567"),
    ("+44 20 7946", "United Kingdom", "+44207946"),
    ("01632 960 001", "United Kingdom", "+1632960001"),
    ("(04930) 1234", "Germany", "+49301234"),
    ("0033 1 23", "France", "+3333123"),
    ("1234 555", "China", "+86234555"),
    ("0800 123", "Italy", "800123"),
    ("800 123", None, "800123"),
    (None, "China", None),
    ("", "Spain", "+34"),
])
def test_phone(spark, phone, country, expected):
    assert run(spark, lambda p, c: add_dial_code(clean_phone(p), c), [(phone, country)]) == [expected]


def test_clean_phone_twice_equals_once(spark):
    raw = ["(1) [2] {3}.4-5 6x77", "  +49 30 ", "x12x3"]
    once = run(spark, clean_phone, raw)
    assert once == ["123456", "+4930", ""] and run(spark, clean_phone, once) == once


def test_phone_shape(spark):
    raw = ["(555) 123-4567x890", "+44 20 7946", "", None, "NLé٣²", "电1"]
    assert run(spark, phone_shape, raw) == [
        "(NNN) NNN-NNNNLNNN", "+NN NN NNNN", "NULL", "NULL", "LLLNN", "LN"]


def test_chinese(spark):
    assert run(spark, has_chinese, ["王伟", "Li", "Store 上", None]) == [True, False, True, None]


def test_default_nulls(spark):
    df = spark.createDataFrame([(None, "x"), ("a", None)], "a string, b string")
    out = default_nulls(df, {"a": "One Size", "b": "All"}).collect()
    assert [tuple(r) for r in out] == [("One Size", "x"), ("a", "All")]


def test_ages(spark):
    as_of = datetime.date(2025, 4, 1)

    def born(years):
        # the first day on which the person counts as this old
        return as_of - datetime.timedelta(days=int(-(-years * 365.25 // 1)))

    edges = [18, 25, 35, 45, 55, 65]
    births = [None, as_of + datetime.timedelta(days=10), datetime.date(1850, 1, 1)]
    births += [born(e) for e in edges] + [born(e) + datetime.timedelta(days=1) for e in edges]
    df = spark.createDataFrame(list(enumerate(births)), "i int, b date")
    age = dates.age_on(F.lit(as_of), F.col("b"))
    rows = df.select("i", age.alias("age"), dates.age_group(age).alias("g")).orderBy("i").collect()
    assert [r.age for r in rows[:3]] == [None] * 3 and {r.g for r in rows[:3]} == {"Unknown"}
    assert [r.age for r in rows[3:9]] == edges
    assert [r.g for r in rows[3:9]] == ["18-24", "25-34", "35-44", "45-54", "55-64", "65+"]
    assert [r.age for r in rows[9:]] == [e - 1 for e in edges]
    assert [r.g for r in rows[9:]] == ["Under 18", "18-24", "25-34", "35-44", "45-54", "55-64"]


def test_calendar(spark):
    row = spark.range(1).select(
        dates.first_of_month(F.to_date(F.lit("2025-03-31"))).alias("first"),
        dates.first_of_next_month(F.to_date(F.lit("2025-03-18"))).alias("next"),
        dates.first_of_next_month(F.to_date(F.lit("2024-12-31"))).alias("year"),
        dates.months_of_operation(F.to_date(F.lit("2025-01-01")),
                                  F.to_date(F.lit("2025-04-15"))).alias("months"),
        dates.months_of_operation(F.to_date(F.lit("2025-01-07")),
                                  F.to_date(F.lit("2025-01-07"))).alias("one"),
        dates.months_of_operation(F.lit(None).cast("date"), F.lit(None).cast("date")).alias("none"),
    ).first()
    assert str(row["first"]) == "2025-03-01" and str(row["next"]) == "2025-04-01"
    assert str(row["year"]) == "2025-01-01"
    assert (float(row["months"]), float(row["one"]), float(row["none"])) == (4.5, 1.0, 0.0)
