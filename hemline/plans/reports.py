"""Reports over the gold tables.

Each takes gold DataFrames and returns the report in its display order. Sorts
run on the few aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hemline.operators.numbering import descending, rank_scores
from hemline.plans.gold import IS_SALE
from hemline.sources.staging import stage


def _money(total: Column) -> Column:
    return F.round(total, 2)


def _share(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` in per cent of ``whole``; NULL of nothing."""
    return F.round(part * 100 / F.nullif(whole, F.lit(0)), digits)


# --- line items -----------------------------------------------------------

def discount_status(lines: DataFrame) -> DataFrame:
    """Lines by type, price kind, and whether a discounted line has its promotion."""
    reduced, known = F.col("Discount") > 0, F.col("DiscountID").isNotNull()
    return (
        lines.select(
            "TransactionType",
            F.when(reduced, "Discounted").otherwise("Regular Price").alias("PriceType"),
            F.when(known, "With DiscountID")
            .when(reduced, "Missing DiscountID")
            .otherwise("No DiscountID Required")
            .alias("DiscountIDStatus"),
        )
        .groupBy("TransactionType", "PriceType", "DiscountIDStatus")
        .agg(F.count(F.lit(1)).alias("RecordCount"))
        .orderBy("TransactionType", "PriceType", "DiscountIDStatus")
    )


def discount_usage(discounts: DataFrame, lines: DataFrame, top: int | None = None) -> DataFrame:
    """Every promotion with its lines and sales, most used first."""
    used = (
        lines.filter(F.col("DiscountID").isNotNull())
        .groupBy("DiscountID")
        .agg(
            F.count("InvoiceID").alias("_lines"),
            F.sum("LineTotalUSD").alias("TotalSales"),
        )
    )
    report = (
        discounts.join(used, "DiscountID", "left")
        .select(
            "DiscountID", "StartDate", "EndDate", "Discount", "Category", "SubCategory",
            F.coalesce("_lines", F.lit(0)).alias("TransactionCount"),
            "TotalSales",
        )
        .orderBy(F.desc("TransactionCount"), "DiscountID")
    )
    return report if top is None else report.limit(top)


def _margins(lines: DataFrame, percent: str, *by: Column) -> DataFrame:
    margin, revenue = F.sum("ContributionMargin"), F.sum("LineTotalUSD")
    return (
        lines.filter(f"{IS_SALE} AND LineTotalUSD > 0")
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("LineItemCount"),
            _money(revenue).alias("TotalRevenue"),
            _money(F.sum("TotalProductionCost")).alias("TotalCost"),
            _money(margin).alias("TotalMargin"),
            _share(margin, revenue).alias(percent),
        )
    )


def margin_overall(lines: DataFrame) -> DataFrame:
    """One row, also when nothing was sold."""
    figures = _margins(lines, "OverallMarginPercentage")
    return figures.select(F.lit("All Sales").alias("Category"), "*")


def margin_by_category(lines: DataFrame) -> DataFrame:
    return _margins(lines, "CategoryMarginPercentage", F.col("Category")).orderBy(
        F.desc("TotalMargin"), "Category"
    )


def margin_by_discount(lines: DataFrame) -> DataFrame:
    """By whether a promotion was found, unlike ``discount_status``."""
    kind = F.when(F.col("DiscountID").isNotNull(), "Discounted").otherwise("Regular Price")
    return _margins(lines, "MarginPercentage", kind.alias("PriceType")).orderBy(
        F.desc("MarginPercentage"), "PriceType"
    )


# Upper bound (exclusive) and label of the margin buckets.
MARGIN_BUCKETS = (
    (0, "Negative Margin"),
    (20, "Low (0-20%)"),
    (40, "Medium (20-40%)"),
    (60, "Good (40-60%)"),
    (80, "High (60-80%)"),
)
TOP_BUCKET = "Very High (80%+)"


def margin_buckets(lines: DataFrame) -> DataFrame:
    percent = F.col("ContributionMarginPercentage")
    number, label = F.lit(len(MARGIN_BUCKETS)), F.lit(TOP_BUCKET)
    for i, (limit, text) in reversed(list(enumerate(MARGIN_BUCKETS))):
        number = F.when(percent < limit, i).otherwise(number)
        label = F.when(percent < limit, text).otherwise(label)
    return (
        lines.filter(f"{IS_SALE} AND LineTotalUSD > 0 AND ContributionMarginPercentage IS NOT NULL")
        .groupBy(number.alias("_bucket"), label.alias("MarginBucket"))
        .agg(
            F.count(F.lit(1)).alias("LineItemCount"),
            _money(F.sum("LineTotalUSD")).alias("TotalRevenue"),
            F.round(F.avg("ContributionMarginPercentage"), 2).alias("AvgMarginPercentage"),
        )
        .orderBy("_bucket")
        .drop("_bucket")
    )


# --- customers ------------------------------------------------------------

def age_distribution(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("AgeGroup").agg(F.count(F.lit(1)).alias("count")).orderBy("AgeGroup")
    )


def age_spending(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("AgeGroup")
        .agg(
            F.count("CustomerID").alias("CustomerCount"),
            _money(F.sum("TotalSpending")).alias("TotalRevenue"),
            _money(F.avg("TotalSpending")).alias("AvgRevenuePerCustomer"),
            _money(F.avg("AverageSpending")).alias("AvgOrderValue"),
        )
        .orderBy("AgeGroup")
    )


def segments_by_age(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("AgeGroup", "RFM_Segment")
        .agg(
            F.count(F.lit(1)).alias("CustomerCount"),
            _money(F.avg("TotalSpending")).alias("AvgSpending"),
            F.round(F.avg("NoOfInvoices"), 2).alias("AvgPurchases"),
        )
        .orderBy("AgeGroup", F.desc("AvgSpending"), "RFM_Segment")
    )


def segments_by_country(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("Country", "RFM_Segment")
        .agg(
            F.count(F.lit(1)).alias("CustomerCount"),
            _money(F.sum("TotalSpending")).alias("TotalRevenue"),
            _money(F.avg("TotalSpending")).alias("AvgSpending"),
        )
        .orderBy("Country", F.desc("TotalRevenue"), "RFM_Segment")
    )


def segment_metrics(customers: DataFrame) -> DataFrame:
    """Key figures per segment, with its share of all revenue."""
    segments = customers.groupBy("RFM_Segment").agg(
        F.count(F.lit(1)).alias("CustomerCount"),
        F.sum("TotalSpending").alias("_revenue"),
        F.round(F.avg("Recency"), 0).alias("AvgDaysSinceLastPurchase"),
        F.round(F.avg("NoOfInvoices"), 1).alias("AvgPurchaseCount"),
        _money(F.avg("AverageSpending")).alias("AvgOrderValue"),
        _share(F.count_if("IsParent"), F.count(F.lit(1)), 1).alias("ParentPercentage"),
    )
    # the total runs over the segments, of which there are as many as rules
    total = F.expr("sum(_revenue) OVER ()")
    return segments.select(
        "RFM_Segment",
        "CustomerCount",
        _money(F.col("_revenue")).alias("TotalRevenue"),
        _share(F.col("_revenue"), total).alias("RevenuePercentage"),
        "AvgDaysSinceLastPurchase",
        "AvgPurchaseCount",
        "AvgOrderValue",
        "ParentPercentage",
    ).orderBy(F.desc("TotalRevenue"), "RFM_Segment")


# --- stores ---------------------------------------------------------------

def stores_by_country(stores: DataFrame) -> DataFrame:
    return (
        stores.groupBy("Country")
        .agg(
            F.count(F.lit(1)).alias("StoreCount"),
            _money(F.sum("TotalSalesUSD")).alias("CountryTotalSales"),
            _money(F.avg("TotalSalesUSD")).alias("AvgStoreRevenue"),
            _money(F.avg("AverageMonthlyUSD")).alias("AvgMonthlyRevenue"),
            F.round(F.avg("ReturnRate"), 2).alias("AvgReturnRate"),
        )
        .orderBy(F.desc("CountryTotalSales"), "Country")
    )


def store_ranking(stores: DataFrame) -> DataFrame:
    """Ranks by sales and monthly sales (highest first) and return rate (lowest first).

    A missing return rate ranks first, as in an ascending sort. The figures are
    staged, because they are sorted and joined.
    """
    stores = stage(stores, "store-figures")
    ranks = rank_scores(
        stores, "StoreID",
        {
            "SalesRank": descending(F.col("TotalSalesUSD")),
            "MonthlyRank": descending(F.col("AverageMonthlyUSD")),
            "QualityRank": F.col("ReturnRate"),
        },
    )
    return (
        stores.join(ranks, "StoreID")
        .select(
            "StoreID", "StoreName", "City", "Country", "TotalSalesUSD", "AverageMonthlyUSD",
            "TotalTransactions", "ReturnRate", "SalesRank", "MonthlyRank", "QualityRank",
        )
        .orderBy("SalesRank", "StoreID")
    )


def underperforming_stores(stores: DataFrame, n: int = 10) -> DataFrame:
    return (
        stores.select(
            "StoreID", "StoreName", "City", "Country", "TotalSalesUSD", "AverageMonthlyUSD",
            "TotalTransactions", "NumberOfEmployees", "ReturnRate",
        )
        .orderBy(F.asc_nulls_first("TotalSalesUSD"), "StoreID")
        .limit(n)
    )
