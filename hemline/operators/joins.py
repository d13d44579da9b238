"""Dimension, currency, promotion and translation joins.

No broadcast hints: dimensions arrive as stored (or staged) tables whose size
the optimizer knows, so it broadcasts the small ones and shuffles the rest, with
adaptive skew splitting. All joins are left joins, which may split a hot left key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hemline.functions.dates import first_of_month
from hemline.sources.staging import stage

MONEY = "decimal(10,4)"


def attach(df: DataFrame, dimension: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Left-join the named columns of a dimension: {dimension column: new name}."""
    side = dimension.select(key, *[F.col(old).alias(new) for old, new in columns.items()])
    return df.join(side, key, "left")


def to_usd(df: DataFrame, rates: DataFrame, amount: str, out: str) -> DataFrame:
    """Convert ``amount`` with the rate of the first of the row's month.

    Dollars stay as they are, and so does an amount whose currency or month has
    no rate. Needs ``Date`` and ``Currency``; rates must be unique per month and
    currency pair.
    """
    usd = rates.filter(F.col("TargetCurrency") == "USD").select(
        F.col("RateDate").alias("_month"),
        F.col("BaseCurrency").alias("_base"),
        F.col("ExchangeRate").cast("decimal(18,8)").alias("_rate"),
    )
    same_rate = (first_of_month(F.col("Date")) == F.col("_month")) & (
        F.col("Currency") == F.col("_base")
    )
    rate = F.coalesce(F.col("_rate"), F.lit(1).cast("decimal(18,8)"))
    value = F.when(F.col("Currency") == "USD", F.col(amount)).otherwise(F.col(amount) * rate)
    return (
        df.join(usd, same_rate, "left")
        .withColumn(out, value.try_cast(MONEY))
        .drop("_month", "_base", "_rate")
    )


def missing_rates(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Rows per month and foreign currency that ``to_usd`` finds no rate for."""
    used = (
        df.filter(F.col("Currency").isNull() | (F.col("Currency") != "USD"))
        .groupBy(first_of_month(F.col("Date")).alias("Month"), "Currency")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = rates.filter(F.col("TargetCurrency") == "USD").select(
        F.col("RateDate").alias("Month"), F.col("BaseCurrency").alias("Currency")
    )
    return used.join(known, ["Month", "Currency"], "left_anti")


def date_span(lines: DataFrame) -> DataFrame:
    """First and last day of the lines, one row."""
    return lines.agg(F.min("Date").alias("first_day"), F.max("Date").alias("last_day"))


def promotion_months(discounts: DataFrame, span: DataFrame) -> DataFrame:
    """One row per promotion and calendar month that it and ``span`` touch.

    Turns the date-range match into an equality on (value, month) with a short
    residual, so it can hash, and spreads over months when it has to shuffle. An
    open-ended promotion lists no months beyond the lines'. Staged, so that the
    listed months, not the promotions, decide how they are joined.
    """
    first, last = span.select("first_day").scalar(), span.select("last_day").scalar()
    within = discounts.select(
        "*", F.greatest("StartDate", first).alias("_first"), F.least("EndDate", last).alias("_last"))
    months = F.sequence(
        first_of_month(F.col("_first")), first_of_month(F.col("_last")), F.expr("interval 1 month"))
    listed = within.filter((F.col("StartDate") <= F.col("EndDate")) & (F.col("_first") <= F.col("_last"))).select(
        F.col("DiscountID"),
        F.col("Discount").alias("_value"),
        F.col("StartDate").alias("_from"),
        F.col("EndDate").alias("_to"),
        F.col("Category").alias("_category"),
        F.col("SubCategory").alias("_subcategory"),
        F.explode(months).alias("_month"),
    )
    return stage(listed, "promotion-months")


def discounted_sale() -> Column:
    return (F.col("TransactionType") == "Sale") & (F.col("Discount") > 0)


def attach_discounts(lines: DataFrame, discounts: DataFrame, span: DataFrame | None = None,
                     match: str = "all") -> DataFrame:
    """Add the DiscountID of the promotions that cover a discounted sale.

    With ``match="all"`` a line covered by several promotions comes out once per
    promotion, so its money is counted as often; any other line comes out once,
    with NULL where nothing matches. This equals matching first and joining back
    on the line key, for a unique line key, without the second shuffle and without
    multiplying lines that share a key. With ``match="first"`` every line comes
    out once, with the lowest DiscountID. ``span`` holds the first and last day of
    the lines (one row), and is taken from them by default.
    """
    if match not in ("all", "first"):
        raise ValueError("match is 'all' or 'first'")
    months = promotion_months(discounts, date_span(lines) if span is None else span)
    everything = F.lit("All")
    if match == "first":
        # one row per value and month, so that the join cannot multiply lines
        listed = months.groupBy("_value", "_month").agg(F.collect_list(
            F.struct("DiscountID", "_from", "_to", "_category", "_subcategory")).alias("_promotions"))
        same = discounted_sale() & (F.col("Discount") == F.col("_value")) & (
            first_of_month(F.col("Date")) == F.col("_month"))
        fitting = F.filter("_promotions", lambda p: F.col("Date").between(p["_from"], p["_to"])
                           & p["_category"].isin(F.col("Category"), everything)
                           & p["_subcategory"].isin(F.col("SubCategory"), everything))
        lowest = F.array_min(F.transform(fitting, lambda p: p["DiscountID"]))
        return lines.join(listed, same, "left").withColumn("DiscountID", lowest).drop(
            "_value", "_month", "_promotions")
    covers = (
        discounted_sale()
        & (F.col("Discount") == F.col("_value"))
        & (first_of_month(F.col("Date")) == F.col("_month"))
        & F.col("Date").between(F.col("_from"), F.col("_to"))
        & F.col("_category").isin(F.col("Category"), everything)
        & F.col("_subcategory").isin(F.col("SubCategory"), everything)
    )
    return lines.join(months, covers, "left").drop(
        "_value", "_from", "_to", "_category", "_subcategory", "_month"
    )


def match_discounts(lines: DataFrame, discounts: DataFrame, span: DataFrame | None = None) -> DataFrame:
    """(InvoiceID, Line, DiscountID) of the discounted sales only."""
    return attach_discounts(lines.filter(discounted_sale()), discounts, span).select(
        "InvoiceID", "Line", "DiscountID"
    )


def names_to_translate(df: DataFrame, eligible: Column, column: str = "Name") -> DataFrame:
    """The distinct texts a translator has to see."""
    return (
        df.filter(eligible & F.col(column).isNotNull())
        .select(F.col(column).alias("original_name"))
        .distinct()
    )


def translate_names(
    df: DataFrame, translations: DataFrame, eligible: Column, column: str = "Name"
) -> DataFrame:
    """Replace eligible names that have a translation; leave all others."""
    known = translations.groupBy("original_name").agg(
        F.min("translated_name").alias("translated_name")
    )
    match = (F.col(column) == F.col("original_name")) & eligible
    return (
        df.join(known, match, "left")
        .withColumn(column, F.coalesce("translated_name", column))
        .drop("original_name", "translated_name")
    )


def actual_employee_counts(stores: DataFrame, employees: DataFrame) -> DataFrame:
    """Stores with the number of their employees, 0 where there are none."""
    counts = employees.groupBy("StoreID").agg(
        F.count("EmployeeID").alias("Actual_Employee_Count")
    )
    return stores.join(counts, "StoreID", "left").fillna({"Actual_Employee_Count": 0})
