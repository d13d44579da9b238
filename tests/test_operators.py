"""Profiles, schema enforcement, joins and numbering on hand-made rows."""

import datetime
import random

import pytest
from pyspark.sql import Window, functions as F

from hemline import schemas
from hemline.operators import joins, numbering, quality

D = datetime.date


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- quality --------------------------------------------------------------

@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "a@x", "+1", 1.0), (1, "a@x", "+1", 1.0), (2, "bad", "2", float("nan")),
         (None, None, "NaN", None), (None, "c@x", None, 2.0)],
        "id int, mail string, tel string, x double")


def test_null_profile(people):
    assert dict(rows(quality.null_profile(people))) == {"id": 2, "mail": 1, "tel": 1, "x": 1}


def test_null_nan_profile(people):
    out = {n: (c, p) for n, c, p in rows(quality.null_nan_profile(people))}
    assert out == {"id": (2, 40.0), "mail": (1, 20.0), "tel": (2, 40.0), "x": (2, 40.0)}


def test_profiles_of_nothing(people):
    empty = people.limit(0)
    assert dict(rows(quality.null_profile(empty)))["id"] == 0
    assert rows(quality.null_nan_profile(empty))[0] == ("id", 0, None)
    assert rows(quality.duplicate_rows(empty)) == [(0,)]


def test_duplicates(people):
    assert rows(quality.duplicate_rows(people)) == [(1,)]
    assert rows(quality.duplicate_keys(people, "id")) == [(2,)]  # NULL is one key
    assert quality.drop_duplicate_rows(people).count() == 4


def test_checks(people):
    assert rows(quality.check_emails(people, "mail")) == [(5, 3, False)]
    assert rows(quality.check_phone_prefix(people.limit(2), "tel")) == [(2, 2, True)]


def test_describe(people):
    out = {r[0]: r[1:] for r in rows(quality.describe_table(people))}
    assert out["id"] == ("int", True, 2, 5) and out["x"] == ("double", True, 1, 5)


def test_same_rows_counts_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "k int, v string")
    assert rows(quality.same_rows(a, b)) == [(3, 3, 1, 1, False)]
    assert rows(quality.same_rows(a, a.orderBy("v"))) == [(3, 3, 0, 0, True)]
    assert (a.exceptAll(b).count(), b.exceptAll(a).count()) == (1, 1)


def test_value_counts_and_distinct(people):
    assert rows(quality.value_counts(people, "mail"))[0] == ("a@x", 2)
    assert rows(quality.distinct_count(people, "id")) == [(3,)]
    assert len(rows(quality.distinct_values(people, "mail"))) == 4


def test_characters(spark):
    df = spark.createDataFrame([("+1 (2)x",), ("3-4",), (None,), ("",), ("55",)], "t string")
    assert {r[0] for r in rows(quality.non_digit_characters(df, "t"))} == set("+ ()x-")
    assert {r[0] for r in rows(quality.extra_characters(df, "t"))} == set(" ()x-")


def test_summary(spark):
    df = spark.range(1, 6).select(F.col("id").cast("decimal(10,2)").alias("v"))
    out = dict(rows(quality.summary_table(df, "v")))
    assert out["count"] == 5 and out["mean"] == 3 and out["50%"] == 3 and out["max"] == 5
    assert round(out["stddev"], 6) == 1.581139


def test_enforce_schema(spark):
    raw = spark.createDataFrame([("1", "2", "Ann", None)],
                                "EmployeeID string, StoreID string, Name string, Position string")
    out = quality.enforce_schema(raw, schemas.EMPLOYEES)
    assert quality.column_types(out.schema) == quality.column_types(schemas.EMPLOYEES)
    assert rows(out) == [(1, 2, "Ann", None)]
    with pytest.raises(Exception, match="NULL in required column Name"):
        quality.enforce_schema(raw.withColumn("Name", F.lit(None).cast("string")),
                               schemas.EMPLOYEES).collect()


def test_split_by_schema(spark):
    raw = spark.createDataFrame([(1, 1, "A", "p"), (None, 1, "B", "p"), (2, 1, None, "p"),
                                 (None, 1, None, "p")],
                                "EmployeeID int, StoreID int, Name string, Position string")
    good = quality.conforming_rows(raw, schemas.EMPLOYEES)
    bad = quality.rejected_rows(raw, schemas.EMPLOYEES)
    assert [r[0] for r in rows(good)] == [1]
    assert sorted(r.missing_columns for r in bad.collect()) == ["EmployeeID", "EmployeeID,Name", "Name"]


# --- numbering ------------------------------------------------------------

def test_number_rows_equals_window(spark):
    # one key holds a third of the rows; many partitions on purpose
    df = spark.range(0, 30_000, 1, 24).select(
        F.when(F.col("id") % 3 == 0, "INV-hot").otherwise(
            F.concat(F.lit("INV-"), (F.xxhash64("id") % 4000).cast("string"))).alias("k"),
        F.when(F.col("id") % 7 != 0, F.col("id")).alias("n"), "id")
    order = [F.asc_nulls_first("k"), F.asc_nulls_first("n"), "id"]
    mine = numbering.number_rows(df, order, "rn", total="all")
    plain = df.withColumn("expected", F.row_number().over(Window.orderBy(*order)))
    joined = mine.join(plain.select("id", "expected"), "id")
    assert joined.count() == 30_000
    assert joined.filter("rn <> expected OR all <> 30000").count() == 0


def test_number_rows_spreads_a_hot_key(spark):
    """The sort splits one key over many partitions, because its order is total."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 40_000, 1, 8).select(F.lit("same").alias("k"), "id")
        out = numbering.number_rows(df, ["k", "id"], "rn")
        files = spark.read.parquet(*out.inputFiles()).groupBy(F.input_file_name().alias("f"))
        sizes = [r["count"] for r in files.count().collect()]
        assert len(sizes) > 4 and max(sizes) < 20_000 and sum(sizes) == 40_000
        assert out.filter("rn <> id + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_number_rows_of_nothing(spark):
    assert numbering.number_rows(spark.range(0), ["id"], "rn").count() == 0


@pytest.mark.parametrize("n", [1, 3, 5, 7, 12, 101])
def test_ntile_equals_window(spark, n):
    random.seed(n)
    data = [(i, random.choice([0, 0, 0, 1, 2, None]), random.randint(0, 3)) for i in range(n)]
    df = spark.createDataFrame(data, "id int, a int, b int")
    mine = numbering.ntile_scores(df, "id", 5, {"ta": F.col("a"), "tb": numbering.descending(F.col("b"))})
    plain = df.select(
        "id",
        F.ntile(5).over(Window.orderBy(F.asc_nulls_first("a"), "id")).alias("ta"),
        F.ntile(5).over(Window.orderBy(F.desc("b"), "id")).alias("tb"))
    assert sorted(rows(mine.select("id", "ta", "tb"))) == sorted(rows(plain))


def test_rank_equals_window(spark):
    data = [(1, "2.5"), (2, "1"), (3, "2.5"), (4, None), (5, "7"), (6, None)]
    df = spark.createDataFrame(data, "id int, t string").select(
        "id", F.col("t").cast("decimal(10,2)").alias("v"))
    mine = numbering.rank_scores(
        df, "id", {"low": F.col("v"), "high": numbering.descending(F.col("v"))})
    plain = df.select(
        "id",
        F.rank().over(Window.orderBy(F.asc_nulls_first("v"))).alias("low"),
        F.rank().over(Window.orderBy(F.desc_nulls_last("v"))).alias("high"))
    assert sorted(rows(mine)) == sorted(rows(plain))


# --- joins ----------------------------------------------------------------

@pytest.fixture(scope="module")
def promotions(spark):
    return spark.createDataFrame(
        [(1, "0.10", "Shirts", "Polo", D(2024, 1, 10), D(2024, 1, 20)),
         (2, "0.10", "Shirts", "All", D(2024, 1, 15), D(2024, 3, 15)),
         (3, "0.50", "All", "All", D(2024, 11, 29), D(2024, 12, 1)),
         (4, "0.10", "Shirts", "Polo", D(2024, 6, 2), D(2024, 6, 1)),
         (5, "0.10", "Shirts", "Polo", None, D(2024, 6, 1)),
         (6, "0.20", None, "All", D(2024, 1, 1), D(2024, 12, 31))],
        "DiscountID int, d string, Category string, SubCategory string, StartDate date, EndDate date"
    ).withColumn("Discount", F.col("d").cast("decimal(10,2)")).drop("d")


def lines_of(spark, data):
    return spark.createDataFrame(
        data, "InvoiceID string, Line int, TransactionType string, d string, Date date, "
              "Category string, SubCategory string"
    ).withColumn("Discount", F.col("d").cast("decimal(10,2)")).drop("d")


CASES = [
    ("exact on start", "Sale", "0.10", D(2024, 1, 10), "Shirts", "Polo", [1]),
    ("two overlap", "Sale", "0.10", D(2024, 1, 20), "Shirts", "Polo", [1, 2]),
    ("day after", "Sale", "0.10", D(2024, 1, 21), "Shirts", "Polo", [2]),
    ("day before", "Sale", "0.10", D(2024, 1, 9), "Shirts", "Polo", [None]),
    ("middle month", "Sale", "0.10", D(2024, 2, 29), "Shirts", "Tee", [2]),
    ("on end", "Sale", "0.10", D(2024, 3, 15), "Shirts", "Tee", [2]),
    ("after end", "Sale", "0.10", D(2024, 3, 16), "Shirts", "Tee", [None]),
    ("store-wide", "Sale", "0.50", D(2024, 11, 30), "Shoes", "Boot", [3]),
    ("store-wide, no product", "Sale", "0.50", D(2024, 12, 1), None, None, [3]),
    ("no product", "Sale", "0.10", D(2024, 1, 15), None, None, [None]),
    ("reversed range", "Sale", "0.10", D(2024, 6, 1), "Shirts", "Polo", [None]),
    ("return", "Return", "0.10", D(2024, 1, 15), "Shirts", "Polo", [None]),
    ("no discount", "Sale", "0.00", D(2024, 1, 15), "Shirts", "Polo", [None]),
    ("NULL discount", "Sale", None, D(2024, 1, 15), "Shirts", "Polo", [None]),
    ("NULL day", "Sale", "0.10", None, "Shirts", "Polo", [None]),
    ("NULL promotion category", "Sale", "0.20", D(2024, 1, 15), "Shirts", "Polo", [None]),
]


def test_attach_discounts(spark, promotions):
    lines = lines_of(spark, [(c[0], 1, *c[1:6]) for c in CASES])
    got = {}
    for r in joins.attach_discounts(lines, promotions).collect():
        got.setdefault(r.InvoiceID, []).append(r.DiscountID)
    assert {k: sorted(v, key=str) for k, v in got.items()} == {c[0]: c[6] for c in CASES}


def test_match_discounts_is_sales_only(spark, promotions):
    lines = lines_of(spark, [(c[0], 1, *c[1:6]) for c in CASES])
    ids = {r.InvoiceID for r in joins.match_discounts(lines, promotions).collect()}
    assert ids == {c[0] for c in CASES if c[1] == "Sale" and c[2] not in ("0.00", None)}


def test_attach_discounts_equals_brute_force(spark, promotions):
    """Random lines against the conditions written out one pair at a time."""
    random.seed(5)
    promos = [r.asDict() for r in promotions.collect()]
    data = [(str(i), i, random.choice(["Sale", "Return"]), random.choice(["0.10", "0.50", "0.00"]),
             D(2024, 1, 1) + datetime.timedelta(days=random.randint(0, 365)),
             random.choice(["Shirts", "Shoes"]), random.choice(["Polo", "Tee"])) for i in range(800)]
    expected = []
    for inv, line, kind, value, day, cat, sub in data:
        hits = [p["DiscountID"] for p in promos
                if kind == "Sale" and float(value) > 0 and float(p["Discount"]) == float(value)
                and p["StartDate"] and p["StartDate"] <= day <= p["EndDate"]
                and p["Category"] in (cat, "All") and p["SubCategory"] in (sub, "All")]
        expected += [(inv, h) for h in hits or [None]]
    got = joins.attach_discounts(lines_of(spark, data), promotions)
    assert sorted(rows(got.select("InvoiceID", "DiscountID")), key=str) == sorted(expected, key=str)


def test_to_usd(spark):
    rates = spark.createDataFrame(
        [(D(2024, 1, 1), "EUR", "USD", "1.25"), (D(2024, 1, 1), "USD", "EUR", "0.8"),
         (D(2024, 2, 1), "EUR", "USD", "1.10")],
        "RateDate date, BaseCurrency string, TargetCurrency string, r string"
    ).withColumn("ExchangeRate", F.col("r").cast("decimal(18,8)"))
    lines = spark.createDataFrame(
        [(1, D(2024, 1, 1), "EUR"), (2, D(2024, 1, 31), "EUR"), (3, D(2024, 2, 29), "EUR"),
         (4, D(2024, 3, 1), "EUR"), (5, D(2024, 1, 5), "USD"), (6, D(2024, 1, 5), None),
         (7, D(2024, 1, 5), "GBP")], "id int, Date date, Currency string"
    ).withColumn("Amount", F.lit("100.0000").cast("decimal(10,4)"))
    out = {r.id: float(r.usd) for r in joins.to_usd(lines, rates, "Amount", "usd").collect()}
    assert out == {1: 125, 2: 125, 3: 110, 4: 100, 5: 100, 6: 100, 7: 100}


def test_to_usd_overflow_is_null(spark):
    rates = spark.createDataFrame([(D(2024, 1, 1), "X", "USD", 9.0)],
                                  "RateDate date, BaseCurrency string, TargetCurrency string, "
                                  "ExchangeRate double")
    lines = spark.createDataFrame([(D(2024, 1, 1), "X")], "Date date, Currency string").withColumn(
        "Amount", F.lit("900000").cast("decimal(10,4)"))
    assert joins.to_usd(lines, rates, "Amount", "usd").first().usd is None


def test_translate_names(spark):
    people = spark.createDataFrame(
        [(1, "王伟", "China"), (2, "王伟", "Spain"), (3, "李", "China"), (4, None, "China")],
        "id int, Name string, Country string")
    words = spark.createDataFrame([("王伟", "Wang Wei"), ("王伟", "Wang Wei")],
                                  "original_name string, translated_name string")
    flag = F.col("Country") == "China"
    out = {r.id: r.Name for r in joins.translate_names(people, words, flag).collect()}
    assert out == {1: "Wang Wei", 2: "王伟", 3: "李", 4: None}
    assert {r[0] for r in rows(joins.names_to_translate(people, flag))} == {"王伟", "李"}
    left = quality.untranslated(joins.translate_names(people, words, flag), flag)
    assert [r.id for r in left.collect()] == [3]


def test_rank_keeps_small_differences(spark):
    df = spark.createDataFrame([(1, 0.00001), (2, 0.00002), (3, 0.00003), (4, None)], "k int, v double")
    out = numbering.rank_scores(df, "k", {"up": F.col("v"), "down": numbering.descending(F.col("v"))})
    assert {r.k: (r.up, r.down) for r in out.collect()} == {1: (2, 3), 2: (3, 2), 3: (4, 1), 4: (1, 4)}


def test_malformed_values_are_rejected(spark):
    raw = spark.createDataFrame(
        [("1", "1", "n", "p"), ("x", "1", "n", "p"), ("2", "y", None, "p")],
        "EmployeeID string, StoreID string, Name string, Position string")
    assert [r.EmployeeID for r in quality.conforming_rows(raw, schemas.EMPLOYEES).collect()] == [1]
    bad = {(r.missing_columns, r.malformed_columns) for r in quality.rejected_rows(raw, schemas.EMPLOYEES).collect()}
    assert ("", "EmployeeID") in bad and ("Name", "StoreID") in bad


def test_open_ended_promotion_lists_the_lines_months(spark):
    promotions = spark.createDataFrame(
        [(1, D(2020, 1, 1), D(9999, 12, 31), 0.5, "All", "All"), (2, D(2024, 1, 1), D(2024, 1, 31), 0.5, "A", "All")],
        "DiscountID int, StartDate date, EndDate date, Discount double, Category string, SubCategory string")
    lines = spark.createDataFrame(
        [("a", 1, "Sale", 0.5, D(2024, 1, 10), "A", "x"), ("b", 1, "Sale", 0.5, D(2024, 3, 1), "B", "x"),
         ("c", 1, "Return", 0.5, D(2024, 1, 10), "A", "x"), ("d", 1, "Sale", 0.4, D(2024, 1, 10), "A", "x")],
        "InvoiceID string, Line int, TransactionType string, Discount double, Date date, Category string, SubCategory string")
    assert joins.promotion_months(promotions, joins.date_span(lines)).count() == 4
    every = sorted((r.InvoiceID, r.DiscountID) for r in joins.attach_discounts(lines, promotions).collect() if r.DiscountID)
    assert every == [("a", 1), ("a", 2), ("b", 1)]
    first = sorted((r.InvoiceID, r.DiscountID or 0) for r in joins.attach_discounts(lines, promotions, match="first").collect())
    assert first == [("a", 1), ("b", 1), ("c", 0), ("d", 0)]
