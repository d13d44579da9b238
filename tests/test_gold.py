"""Gold jobs and reports on hand-made rows."""

import datetime
from decimal import Decimal

import pytest

from hemline import schemas
from pyspark.sql import functions as F

from hemline.plans import gold, lookups, reports, silver
from hemline.sources.serving import SERVING, fitting_rows, rejected_values, serving_columns, to_serving

D = datetime.date


def rows(df):
    return [tuple(r) for r in df.collect()]


def money(df, *names, kind="decimal(10,4)"):
    return df.withColumns({n: F.col(n).cast(kind) for n in names})


# --- margins --------------------------------------------------------------

def test_margin(spark):
    lines = money(spark.createDataFrame(
        [(1, "Sale", "100", "20", 2), (2, "Return", "-100", "20", 2), (3, "Sale", "0", "20", 1),
         (4, "Sale", "30", "20", 2), (5, "Sale", "50", None, 1)],
        "id int, TransactionType string, LineTotalUSD string, ProductionCost string, Quantity int"),
        "LineTotalUSD", "ProductionCost")
    out = {r.id: (r.TotalProductionCost, r.ContributionMargin, r.ContributionMarginPercentage)
           for r in gold.with_margin(lines).collect()}
    assert out[1] == (Decimal(40), Decimal(60), Decimal(60))
    assert out[2] == (Decimal(40), None, None)
    assert out[3] == (Decimal(20), Decimal(-20), None)
    assert out[4] == (Decimal(40), Decimal(-10), Decimal("-33.33"))
    assert out[5] == (None, None, None)


def test_margin_buckets_edges(spark):
    shares = ["-0.01", "0", "19.99", "20", "40", "60", "79.99", "80", "100"]
    lines = money(spark.createDataFrame(
        [("Sale", "1", s) for s in shares] + [("Sale", "1", None), ("Return", "1", "5")],
        "TransactionType string, LineTotalUSD string, ContributionMarginPercentage string"),
        "LineTotalUSD", "ContributionMarginPercentage")
    assert [(r[0], r[1]) for r in rows(reports.margin_buckets(lines))] == [
        ("Negative Margin", 1), ("Low (0-20%)", 2), ("Medium (20-40%)", 1), ("Good (40-60%)", 1),
        ("High (60-80%)", 2), ("Very High (80%+)", 2)]


def sold_lines(spark, data):
    return money(spark.createDataFrame(
        data, "InvoiceID string, TransactionType string, Category string, Discount string, "
              "DiscountID int, LineTotalUSD string, TotalProductionCost string, "
              "ContributionMargin string"),
        "Discount", "LineTotalUSD", "TotalProductionCost", "ContributionMargin")


def test_margin_reports(spark):
    lines = sold_lines(spark, [
        ("a", "Sale", "Shoes", "0.1", 1, "100", "40", "60"), ("b", "Sale", "Shoes", "0", None, "50", "40", "10"),
        ("c", "Sale", "Hats", "0.1", None, "10", "20", "-10"), ("d", "Return", "Hats", "0.1", None, "-10", "2", None)])
    assert rows(reports.margin_overall(lines)) == [
        ("All Sales", 3, Decimal("160.00"), Decimal("100.00"), Decimal("60.00"), Decimal("37.50"))]
    assert [r[:2] for r in rows(reports.margin_by_category(lines))] == [("Shoes", 2), ("Hats", 1)]
    assert {r[0]: r[1] for r in rows(reports.margin_by_discount(lines))} == {
        "Discounted": 1, "Regular Price": 2}
    assert rows(reports.discount_status(lines)) == [
        ("Return", "Discounted", "Missing DiscountID", 1),
        ("Sale", "Discounted", "Missing DiscountID", 1),
        ("Sale", "Discounted", "With DiscountID", 1),
        ("Sale", "Regular Price", "No DiscountID Required", 1)]
    by_category = sum(r[2] for r in rows(reports.margin_by_category(lines)))
    assert by_category == rows(reports.margin_overall(lines))[0][2]
    empty = rows(reports.margin_overall(lines.limit(0)))
    assert empty == [("All Sales", 0, None, None, None, None)]


def test_discount_usage_keeps_unused(spark):
    promos = spark.createDataFrame(
        [(i, None, None, None, "A", "B") for i in (1, 2, 3)],
        "DiscountID int, StartDate date, EndDate date, Discount decimal(10,2), Category string, "
        "SubCategory string")
    lines = sold_lines(spark, [("a", "Sale", "x", "0.1", 2, "5", "1", "4")] * 2)
    assert [(r[0], r[6], r[7]) for r in rows(reports.discount_usage(promos, lines))] == [
        (2, 2, Decimal(10)), (1, 0, None), (3, 0, None)]
    assert len(rows(reports.discount_usage(promos, lines, top=1))) == 1


# --- customers ------------------------------------------------------------

@pytest.fixture(scope="module")
def purchases(spark):
    return money(spark.createDataFrame(
        [(1, "i1", "Sale", "Children", D(2024, 1, 5), "10"), (1, "i1", "Sale", "Children", D(2024, 1, 5), "20"),
         (1, "i2", "Sale", "Shoes", D(2024, 2, 5), "30"), (1, "i3", "Return", "Shoes", D(2024, 3, 5), "-30"),
         (2, "i4", "Return", "Children", D(2024, 3, 20), "-5"), (3, "i5", "Sale", "Children", D(2023, 1, 1), "1"),
         (None, "i6", "Sale", "Children", D(2023, 1, 1), "99")],
        "CustomerID int, InvoiceID string, TransactionType string, Category string, Date date, "
        "LineTotalUSD string"), "LineTotalUSD")


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(i, f"N{i}", None, None, "c", "Spain", "F", D(1990, 1, 1), "j") for i in (1, 2, 3, 4)],
        "CustomerID int, Name string, Email string, Telephone string, City string, Country string, "
        "Gender string, DateOfBirth date, JobTitle string")


def test_customer_metrics_agree_with_single_figures(purchases):
    metrics = {r.CustomerID: r for r in gold.customer_metrics(purchases).collect()}
    spending = {r.CustomerID: r for r in gold.customer_spending(purchases).collect()}
    last = dict(rows(gold.customer_last_purchase(purchases)))
    parents = dict(rows(gold.parent_customers(purchases)))
    for key, r in spending.items():
        assert (metrics[key].TotalSpending, metrics[key].NoOfInvoices, metrics[key].AverageSpending) == (
            r.TotalSpending, r.NoOfInvoices, r.AverageSpending)
        assert metrics[key].LastPurchaseDate == last[key]
    assert parents == {1: 2} and metrics[1].ChildrenPurchases == 2
    assert metrics[2].NoOfInvoices == 0 and metrics[2].TotalSpending is None
    assert metrics[2].LastActivityDate == D(2024, 3, 20)


def test_gold_customers(people, purchases):
    out = {r.CustomerID: r for r in gold.gold_customers(people, gold.customer_metrics(purchases)).collect()}
    assert sorted(out) == [1, 2, 3, 4]
    assert out[1].IsParent and not out[2].IsParent and not out[3].IsParent
    assert (out[1].TotalSpending, out[1].NoOfInvoices, out[1].AverageSpending) == (Decimal(60), 2, Decimal(30))
    assert (out[4].TotalSpending, out[4].NoOfInvoices, out[4].Recency) == (0, 0, 0)
    # the last line is on 20 March 2024, a return; days count to 1 April
    assert out[1].Recency == (D(2024, 4, 1) - D(2024, 2, 5)).days
    assert out[1].Age == 34 and out[1].AgeGroup == "25-34"
    fixed = gold.gold_customers(people, gold.customer_metrics(purchases), F.lit(D(2025, 4, 1)))
    assert {r.CustomerID: r.Age for r in fixed.collect()}[1] == 35


SCORES = {
    (5, 5, 5): "Champions", (3, 3, 3): "Loyal", (4, 3, 2): "Potential Loyalists",
    (3, 2, 3): "Big Spenders", (1, 4, 4): "At Risk", (1, 3, 2): "Need Attention",
    (1, 2, 2): "About to Leave", (4, 1, 1): "New", (2, 2, 3): "High Value Prospects",
    (2, 2, 2): "Others", (3, 1, 1): "Others", (5, 2, 1): "Others", (2, 5, 5): "Others",
}


def test_rfm_rules(spark):
    df = spark.createDataFrame(list(SCORES), "R_Score int, F_Score int, M_Score int")
    got = {tuple(r)[:3]: r.RFM_Segment for r in df.withColumn("RFM_Segment", gold.rfm_segment()).collect()}
    assert got == SCORES


def test_rfm_scores_direction(spark):
    rfm = spark.createDataFrame([(i, 100 - i, i, Decimal(i)) for i in range(10)],
                                "CustomerID int, Recency int, Frequency int, Monetary decimal(20,4)")
    out = {r.CustomerID: r.RFM_Score for r in gold.rfm_scores(rfm).collect()}
    assert out[0] == "111" and out[9] == "555"


def test_segment_metrics_add_up(spark, people, purchases):
    customers = gold.gold_customers(people, gold.customer_metrics(purchases))
    out = reports.segment_metrics(customers).collect()
    assert sum(r.CustomerCount for r in out) == 4
    assert abs(sum(r.RevenuePercentage for r in out) - 100) < Decimal("0.1")
    assert sum(r.CustomerCount for r in reports.segments_by_age(customers).collect()) == 4


# --- stores ---------------------------------------------------------------

def test_gold_stores(spark):
    lines = money(spark.createDataFrame(
        [(1, "a", "Sale", D(2024, 1, 1), "100"), (1, "a", "Sale", D(2024, 1, 1), "50"),
         (1, "b", "Return", D(2024, 4, 15), "-30"), (2, "c", "Return", D(2024, 1, 1), "-5"),
         (3, "d", "Sale", D(2024, 1, 1), "0"), (3, "e", "Return", D(2024, 1, 1), "-5"),
         (4, "f", "Sale", D(2024, 1, 31), "1"), (4, "f", "Sale", D(2024, 2, 29), "1")],
        "StoreID int, InvoiceID string, TransactionType string, Date date, LineTotalUSD string"),
        "LineTotalUSD")
    stores = spark.createDataFrame(
        [(i, "C", "c", "s", 1, "z", None, None) for i in (1, 2, 3, 4, 5)],
        "StoreID int, Country string, City string, StoreName string, NumberOfEmployees int, "
        "ZIPCode string, Latitude decimal(10,6), Longitude decimal(10,6)")
    out = {r.StoreID: r for r in gold.gold_stores(stores, gold.store_metrics(lines)).collect()}
    assert (out[1].TotalSalesUSD, out[1].TotalTransactions, out[1].TotalReturns) == (150, 1, 1)
    assert (out[1].AverageMonthlyUSD, out[1].ReturnRate) == (75, 20)
    assert out[1].MonthsOfOperation == Decimal("4.5")
    assert (out[2].ReturnRate, out[2].TotalSalesUSD, out[2].TotalReturns) == (0, 0, 1)
    assert out[3].ReturnRate is None and out[3].TotalTransactions == 1
    assert out[4].TotalTransactions == 1 and out[4].MonthsOfOperation == 2
    assert (out[5].TotalSalesUSD, out[5].AverageMonthlyUSD, out[5].MonthsOfOperation) == (0, 0, 0)
    all_stores = gold.gold_stores(stores, gold.store_metrics(lines))
    ranking = {r.StoreID: (r.SalesRank, r.QualityRank) for r in reports.store_ranking(all_stores).collect()}
    assert ranking == {1: (1, 5), 4: (2, 2), 2: (3, 2), 3: (3, 1), 5: (3, 2)}
    assert [r.StoreID for r in reports.underperforming_stores(all_stores, 2).collect()] == [2, 3]


# --- rates, discounts, employees, lookups ---------------------------------

def test_exchange_rates(spark):
    bounds = spark.createDataFrame([(D(2023, 11, 15), D(2024, 2, 1))], "first_day date, last_day date")
    spine = gold.month_spine(bounds)
    assert [str(r[0]) for r in spine.orderBy("RateDate").collect()] == [
        "2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01"]
    feed = spark.createDataFrame(
        [(D(2024, 1, 1), "EUR", Decimal("0.8")), (D(2024, 2, 1), "EUR", Decimal(0)),
         (D(2022, 1, 1), "EUR", Decimal("0.9"))],
        "RateDate date, TargetCurrency string, Rate decimal(18,8)")
    got = sorted((str(a), b, c, float(d)) for a, b, c, d in rows(gold.exchange_rates(spine, feed)))
    assert got == [("2024-01-01", "EUR", "USD", 1.25), ("2024-01-01", "USD", "EUR", 0.8),
                   ("2024-02-01", "USD", "EUR", 0.0)]


def test_silver_discounts(spark):
    df = spark.createDataFrame(
        [(D(2024, 1, 1), D(2024, 1, 2), Decimal("0.5"), "b", None, None),
         (D(2024, 1, 1), D(2024, 1, 2), Decimal("0.2"), "a", "CHILDREN",
          "Girl and Boy (1-5 years, 6-14 years)"),
         (D(2024, 1, 1), D(2024, 1, 2), Decimal("0.2"), "a", "ACCESSORIES", " HATS")],
        "StartDate date, EndDate date, Discount decimal(10,2), Description string, Category string, "
        "SubCategory string")
    out = silver.discounts(df)
    assert out.columns[:4] == ["StartDate", "EndDate", "DiscountID", "Discount"]
    assert sorted((r.DiscountID, r.Category, r.SubCategory) for r in out.collect()) == [
        (1, "Accessories", "Hats"), (2, "Children", "Children(1-14 Years)"), (3, "All", "All")]


def test_employee_counts(spark):
    stores = spark.createDataFrame([(1, "a", 2), (2, "b", 5), (3, "c", 1), (4, "d", None)],
                                   "StoreID int, StoreName string, NumberOfEmployees int")
    staff = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 4)], "EmployeeID int, StoreID int")
    assert dict((r.StoreID, r.NumberOfEmployees)
                for r in silver.reconcile_employees(stores, staff).collect()) == {1: 2, 2: 1, 3: 0, 4: None}
    assert sorted(rows(silver.employee_discrepancies(stores, staff))) == [(2, "b", 5, 1), (3, "c", 1, 0)]


def test_lookups(people):
    assert lookups.customer_by_id(people, 2).count() == 1
    assert [r.CustomerID for r in lookups.customers_by_name(people, "n", n=3).collect()] == [1, 2, 3]
    assert lookups.customers_by_name(people, "n", case_sensitive=True).count() == 0
    assert lookups.customers_by_name(people, "x' OR '1'='1").count() == 0


def test_product_sales(spark):
    products = spark.createDataFrame(
        [(i, "a", "b", "d", "c", "s", Decimal(1)) for i in (1, 2)],
        "ProductID int, Category string, SubCategory string, DescriptionEN string, Color string, "
        "Sizes string, ProductionCost decimal(10,4)")
    lines = spark.createDataFrame(
        [(2, 7, 3, Decimal(9)), (2, 7, 1, Decimal(1)), (2, 8, 1, Decimal(1)), (2, None, 1, Decimal(1))],
        "ProductID int, CustomerID int, Quantity int, LineTotalUSD decimal(10,4)")
    got = [(r.ProductID, r.TotalQuantitySold, float(r.TotalRevenue), r.UniqueCustomers)
           for r in lookups.product_sales(products, lines).collect()]
    assert got == [(2, 6, 12.0, 2), (1, 0, 0.0, 0)]


# --- serving --------------------------------------------------------------

def test_serving_layouts():
    widths = {name: len(serving_columns(name)) for name in SERVING}
    assert widths == {"customers": 17, "discounts": 7, "employees": 4, "exchange_rates": 4,
                      "invoice_fact": 15, "invoice_line_items": 25, "products": 12, "stores": 14}


def test_serving_ranges(spark):
    df = spark.createDataFrame([(3_000_000_000, 1), (5, 1)], "EmployeeID long, StoreID long").withColumns(
        {"Position": F.lit("p"), "Name": F.lit("n")})
    out = fitting_rows(df, "employees")
    assert out.columns == ["EmployeeID", "StoreID", "Name", "Position"]
    assert [r.EmployeeID for r in out.collect()] == [5]
    assert [tuple(r) for r in rejected_values(df, "employees").collect()] == [
        ("employees", "3000000000", "EmployeeID", "3000000000")]
    with pytest.raises(Exception, match="EmployeeID does not fit int"):
        to_serving(df, "employees").collect()
    assert to_serving(df.filter("EmployeeID = 5"), "employees").count() == 1


def test_serving_smallmoney(spark):
    names = [n for n, _ in serving_columns("products") if n != "ProductionCost"]
    df = spark.createDataFrame([("214748.3647",), ("214748.3648",), (None,)], "p string").select(
        *[F.lit("1").alias(n) for n in names], F.col("p").cast("decimal(12,4)").alias("ProductionCost"))
    got = [r.ProductionCost for r in fitting_rows(df, "products").collect()]
    assert got == [Decimal("214748.3647"), None]
    assert [r.value for r in rejected_values(df, "products").collect()] == ["214748.3648"]


# --- scale ----------------------------------------------------------------

def test_busy_store_keeps_its_average(spark):
    lines = spark.createDataFrame(
        [(1, "Sale", f"I{k}", Decimal("900000"), datetime.date(2024, 1, 5)) for k in range(4)],
        "StoreID int, TransactionType string, InvoiceID string, LineTotalUSD decimal(10,4), Date date")
    names = [f.name for f in schemas.STORES.fields if f.name != "StoreID"]
    stores = spark.createDataFrame([(1,)], "StoreID int").select(
        "StoreID", *[F.lit(None).cast(schemas.STORES[n].dataType).alias(n) for n in names])
    out = gold.gold_stores(stores, gold.store_metrics(lines)).first()
    assert (out.AverageMonthlyUSD, out.TotalTransactions) == (3_600_000, 4)


def test_store_metrics_has_no_expand(spark):
    lines = spark.createDataFrame(
        [(1, "Sale", "A", Decimal("1"), datetime.date(2024, 1, 31)), (1, "Sale", "A", Decimal("1"), datetime.date(2024, 2, 1)),
         (1, "Return", "B", Decimal("-1"), datetime.date(2024, 2, 1)), (1, "Sale", None, Decimal("1"), None)],
        "StoreID int, TransactionType string, InvoiceID string, LineTotalUSD decimal(10,4), Date date")
    out = gold.store_metrics(lines)
    assert "Expand" not in out._jdf.queryExecution().toString()
    r = out.first()
    assert (r.TotalTransactions, r.TotalReturns, r.MonthsWithTransactions) == (1, 1, 2)
