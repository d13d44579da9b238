"""A third of all rows under one customer, invoice, product, store and discount."""

import pytest
from pyspark.sql import functions as F

from hemline.operators import joins
from hemline.plans import gold, lookups

SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
}


@pytest.fixture(scope="module")
def session(spark):
    before = {k: spark.conf.get(k) for k in SPLIT_EARLY}
    for k, v in SPLIT_EARLY.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def lines(session):
    hot = F.col("id") % 3 == 0

    def spread(n):
        return F.when(hot, F.lit(7)).otherwise((F.col("id") * 31 % n).cast("int"))

    return session.range(0, 30_000, 1, 8).select(
        F.concat(F.lit("INV-"), spread(4000)).alias("InvoiceID"), F.col("id").cast("int").alias("Line"),
        spread(300).alias("CustomerID"), spread(200).alias("ProductID"), spread(20).alias("StoreID"),
        F.when(F.col("id") % 5 == 0, "Return").otherwise("Sale").alias("TransactionType"),
        F.when(F.col("id") % 2 == 0, "Children").otherwise("Shoes").alias("Category"),
        F.lit("Any").alias("SubCategory"), F.lit(2).alias("Quantity"),
        (F.col("id") % 97).cast("decimal(10,4)").alias("LineTotalUSD"),
        F.when(hot, 0.1).otherwise((F.col("id") % 9) / 100).cast("decimal(10,2)").alias("Discount"),
        F.expr("date_add(DATE'2024-01-01', CAST(id % 60 AS INT))").alias("Date"),
    )


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_customers(lines):
    sales = gold.customer_spending(lines).withColumn("TotalSpending", F.col("TotalSpending").cast("decimal(20,4)"))
    metrics = gold.customer_metrics(lines).filter("NoOfInvoices > 0")
    assert same(sales, metrics.select(*sales.columns))


def test_stores(session, lines):
    plain = session.sql(
        """SELECT StoreID, CAST(sum(CASE WHEN TransactionType = 'Sale' THEN LineTotalUSD ELSE 0 END) AS DECIMAL(24,4))
             AS TotalSalesUSD, count(DISTINCT CASE WHEN TransactionType = 'Sale' THEN InvoiceID END) AS TotalTransactions,
             count(DISTINCT CASE WHEN TransactionType = 'Return' THEN InvoiceID END) AS TotalReturns,
             count(DISTINCT date_format(Date, 'yyyy-MM')) AS MonthsWithTransactions
           FROM {lines} GROUP BY StoreID""", lines=lines)
    assert same(plain, gold.store_metrics(lines))


def test_products(session, lines):
    products = session.range(0, 210).select(
        F.col("id").cast("int").alias("ProductID"), F.lit("c").alias("Category"), F.lit("s").alias("SubCategory"),
        F.lit("d").alias("DescriptionEN"), F.lit("r").alias("Color"), F.lit("m").alias("Sizes"),
        F.lit(1).cast("decimal(10,4)").alias("ProductionCost"))
    plain = session.sql(
        """SELECT p.ProductID, coalesce(sum(Quantity), 0) AS TotalQuantitySold,
             count(DISTINCT CustomerID) AS UniqueCustomers
           FROM {p} p LEFT JOIN {l} l ON p.ProductID = l.ProductID GROUP BY p.ProductID""", p=products, l=lines)
    assert same(plain, lookups.product_sales(products, lines))


def test_promotions(session, lines):
    promotions = session.createDataFrame(
        [(1, "0.10", "Shoes", "Any", "2024-01-10", "2024-02-10"), (2, "0.10", "All", "All", "2024-02-01", "2024-02-29"),
         (3, "0.05", "Children", "All", "2024-01-01", "2024-01-31")],
        "DiscountID int, d string, Category string, SubCategory string, a string, b string").select(
        "DiscountID", F.col("d").cast("decimal(10,2)").alias("Discount"), "Category", "SubCategory",
        F.to_date("a").alias("StartDate"), F.to_date("b").alias("EndDate"))
    plain = session.sql(
        """SELECT l.Line, d.DiscountID FROM {l} l LEFT JOIN {d} d ON l.Discount = d.Discount
             AND l.Date BETWEEN d.StartDate AND d.EndDate AND l.TransactionType = 'Sale' AND l.Discount > 0
             AND (d.Category = l.Category OR d.Category = 'All')
             AND (d.SubCategory = l.SubCategory OR d.SubCategory = 'All')""", l=lines, d=promotions)
    mine = joins.attach_discounts(lines, promotions).select("Line", "DiscountID")
    assert mine.filter("DiscountID IS NOT NULL").count() > 5_000
    assert same(plain, mine)


def test_numbers(lines):
    numbered = gold.number_line_items(lines.select("InvoiceID", "Line").withColumn("DiscountID", F.lit(None).cast("int")))
    spread = numbered.agg(F.min("LineItemID"), F.max("LineItemID"), F.count_distinct("LineItemID")).first()
    assert tuple(spread) == (1, 30_000, 30_000)
