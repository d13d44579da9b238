"""Bronze CSV to gold through stored tables."""

import datetime
from decimal import Decimal

import pytest

from hemline import schemas
from hemline.plans.flow import run_gold, run_silver
from hemline.sources.tables import Catalog, read_table

D = datetime.date

BRONZE = {
    "stores": '''"StoreID","Country","City","StoreName","NumberOfEmployees","ZIPCode","Latitude","Longitude"
"1","中国","上海","Store 上海","2","200000","31.200000","121.500000"
"2","United States","New York","Store New York","9","10001","40.700000","-74.000000"
''',
    "employees": '''"EmployeeID","StoreID","Name","Position"
"1","1","王伟","store MANAGER"
"2","2","Dr. Ann Lee","Clerk"
"3","6","王伟","Clerk"
''',
    "products": '''"ProductID","Category","SubCategory","DescriptionPT","DescriptionDE","DescriptionFR","DescriptionES","DescriptionEN","DescriptionZH","Color","Sizes","ProductionCost"
"1","CHILDREN","Girl and Boy (1-5 years, 6-14 years)","","","","","Coat","","RED","S|M","10.0000"
"2","MASCULINE","T-shirts","","","","","Shirt","","","","4.5000"
''',
    "discounts": '''"StartDate","EndDate","Discount","Description","Category","SubCategory"
"2024-11-28","2024-12-01","0.60","Black Friday","",""
"2024-01-01","2024-01-31","0.20","Winter","CHILDREN","Girl and Boy (1-5 years, 6-14 years)"
''',
    "customers": '''"CustomerID","Name","Email","Telephone","City","Country","Gender","DateOfBirth","JobTitle"
"1","Dr. Bob STONE","b@x.com","(555) 123-4567x9","new york","United States","M","1990-05-05",""
"2","李雷","l@x.cn","0 10 1234","上海","中国","F","2001-02-03","engineer"
''',
    "transactions": '''"InvoiceID","Line","CustomerID","ProductID","Size","Color","UnitPrice","Quantity","Timestamp","Discount","LineTotal","StoreID","EmployeeID","Currency","CurrencySymbol","SKU","TransactionType","PaymentMethod","InvoiceTotal"
"INV-1","1","1","1","M","","50.0000","2","2024-01-15 10:20:30","0.20","80.0000","2","2","USD","$","A","Sale","cash","100.0000"
"INV-1","2","1","2","","BLUE","20.0000","1","2024-01-15 10:20:30","0.00","20.0000","2","2","USD","$","B","Sale","cash","100.0000"
"INV-1","2","1","2","","BLUE","20.0000","1","2024-01-15 10:20:30","0.00","20.0000","2","2","USD","$","B","Sale","cash","100.0000"
"INV-2","1","2","1","S","RED","400.0000","1","2024-11-29 23:59:59","0.60","160.0000","1","1","CNY","¥","A","Sale","Credit CARD","160.0000"
"RET-1","1","2","1","S","RED","400.0000","1","2024-12-02 08:00:00","0.60","-160.0000","1","1","CNY","¥","A","Return","Credit CARD","-160.0000"
''',
}


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for name, text in BRONZE.items():
        folder = root / "bronze" / name
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text(text, encoding="utf-8")
    catalog = Catalog(str(root))
    words = spark.createDataFrame([("王伟", "Wang Wei"), ("李雷", "Li Lei")],
                                  "original_name string, translated_name string")
    feed = spark.createDataFrame(
        [(D(2024, 11, 1), "CNY", Decimal("8")), (D(2024, 1, 1), "CNY", Decimal("7"))],
        "RateDate date, TargetCurrency string, Rate decimal(18,8)")
    silver = run_silver(spark, catalog, words)
    gold = run_gold(spark, catalog, feed, D(2024, 1, 1), D(2024, 12, 31))
    for report in (silver, gold):
        assert all(r.counts_match and r.types_match for r in report.collect())
    return catalog


def table(spark, catalog, layer, name):
    schema = (schemas.SILVER if layer == "silver" else schemas.GOLD)[name]
    return read_table(spark, getattr(catalog, layer)(name), schema).collect()


def test_silver(spark, catalog):
    stores = {r.StoreID: r for r in table(spark, catalog, "silver", "stores")}
    assert (stores[1].Country, stores[1].City, stores[1].StoreName) == ("China", "Shanghai", "Store Shanghai")
    assert (stores[1].NumberOfEmployees, stores[2].NumberOfEmployees) == (1, 1)
    names = {r.EmployeeID: r.Name for r in table(spark, catalog, "silver", "employees")}
    assert names == {1: "王伟", 2: "Ann Lee", 3: "Wang Wei"}  # store 1 is not flagged
    people = {r.CustomerID: r for r in table(spark, catalog, "silver", "customers")}
    assert (people[1].Name, people[1].Telephone, people[1].JobTitle) == ("Bob Stone", "+15551234567", "Not Specified")
    assert (people[2].Name, people[2].Telephone) == ("Li Lei", "+101234")
    assert len(table(spark, catalog, "silver", "transactions")) == 4
    products = {r.ProductID: r for r in table(spark, catalog, "silver", "products")}
    assert products[1].SubCategory == "Children(1-14 Years)"
    assert (products[2].Color, products[2].Sizes) == ("Not Specified", "One Size")
    assert {r.DiscountID: r.Category for r in table(spark, catalog, "silver", "discounts")} == {
        1: "Children", 2: "All"}


def test_gold_lines(spark, catalog):
    lines = table(spark, catalog, "gold", "invoice_line_items")
    assert [r.LineItemID for r in sorted(lines, key=lambda r: (r.InvoiceID, r.Line))] == [1, 2, 3, 4]
    by_key = {(r.InvoiceID, r.Line): r for r in lines}
    first = by_key["INV-1", 1]
    assert (first.DiscountID, first.LineTotalUSD, first.ContributionMargin) == (1, 80, 60)
    assert first.ContributionMarginPercentage == 75
    assert by_key["INV-1", 2].DiscountID is None
    assert (by_key["INV-2", 1].LineTotalUSD, by_key["INV-2", 1].DiscountID) == (20, 2)
    back = by_key["RET-1", 1]
    # no December rate, so the amount stays as it is; returns have no promotion or margin
    assert (back.LineTotalUSD, back.DiscountID, back.ContributionMargin) == (-160, None, None)


def test_gold_invoices(spark, catalog):
    out = {r.InvoiceID: r for r in table(spark, catalog, "gold", "invoice_fact")}
    assert (out["INV-1"].TotalQuantity, out["INV-1"].Time, out["INV-1"].StoreCity) == (3, "10:20:30", "New York")
    assert out["INV-2"].InvoiceTotalUSD == 20


def test_gold_customers_and_stores(spark, catalog):
    people = {r.CustomerID: r for r in table(spark, catalog, "gold", "customers")}
    assert (people[1].TotalSpending, people[1].NoOfInvoices, people[1].IsParent) == (100, 1, False)
    assert people[2].Recency == (D(2025, 1, 1) - D(2024, 11, 29)).days
    stores = {r.StoreID: r for r in table(spark, catalog, "gold", "stores")}
    assert (stores[1].TotalSalesUSD, stores[1].ReturnRate, stores[1].TotalReturns) == (20, 800, 1)
    assert stores[2].MonthsOfOperation == 1


def test_promoted_tables_are_unchanged(spark, catalog):
    for name in ("discounts", "products", "employees"):
        assert sorted(map(str, table(spark, catalog, "gold", name))) == sorted(
            map(str, table(spark, catalog, "silver", name)))


def test_rerun_replaces_and_extends_rates(spark, catalog):
    """A second run, whatever the mode of its environment, gives the same tables."""
    before = {n: sorted(map(str, table(spark, catalog, "gold", n))) for n in (
        "invoice_fact", "invoice_line_items", "customers", "stores")}
    run_gold(spark, catalog, spark.createDataFrame([], schemas.RATES_FEED), D(2024, 1, 1), D(2024, 12, 31))
    assert before == {n: sorted(map(str, table(spark, catalog, "gold", n))) for n in before}
    missing = read_table(spark, catalog.gold("missing_rates")).collect()
    assert [(r.Month, r.Currency, r.row_count) for r in missing] == [(D(2024, 12, 1), "CNY", 1)]
    more = spark.createDataFrame([(D(2024, 12, 1), "CNY", Decimal("8"))],
                                 "RateDate date, TargetCurrency string, Rate decimal(18,8)")
    run_gold(spark, catalog, more, D(2024, 1, 1), D(2025, 12, 31))
    lines = table(spark, catalog, "gold", "invoice_line_items")
    assert {float(r.LineTotalUSD) for r in lines} == {80.0, 20.0, -20.0}
    assert len({r.LineItemID for r in lines}) == len(lines) == 4
    assert read_table(spark, catalog.gold("missing_rates")).count() == 0


def test_bad_bronze_rows_are_set_aside(spark, tmp_path):
    for name, text in BRONZE.items():
        folder = tmp_path / "bronze" / name
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text(text + ('"x","1","Eve","Clerk"\n' if name == "employees" else ""), encoding="utf-8")
    lake = Catalog(str(tmp_path))
    run_silver(spark, lake, None)
    bad = read_table(spark, lake.silver("rejected_employees")).collect()
    assert [(r.Name, r.malformed_columns) for r in bad] == [("Eve", "EmployeeID")]
    assert len(table(spark, lake, "silver", "employees")) == 3
