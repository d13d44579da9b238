"""Large inputs are joined, parsed and sorted once, whatever is made of them."""

import datetime

import pytest
from pyspark.sql import DataFrame, functions as F

import __spark_entry__ as entry
from hemline import schemas
from hemline.plans import flow, gold
from hemline.sources import versions
from hemline.sources.tables import Catalog
from tests.test_flow import BRONZE

D = datetime.date


def files(df, *parts):
    return [f for f in df.inputFiles() if any(p in f for p in parts)]


def test_queries_join_lines_with_their_orders_once(spark, data):
    for name in ("silver_transactions", "sample_rows"):
        df = entry.queries()[name](spark, data)
        assert files(df, "bronze-lines-") and not files(df, "lineitem.parquet")


def test_staged_scans_read_only_what_is_used(spark, data):
    lines = entry.StagedShop(spark, data).lines
    text = entry.reports.margin_by_category(lines)._jdf.queryExecution().executedPlan().toString()
    # rows whose key occurs once come first; only suspects are compared in all bronze columns
    scan = next(x for x in text.splitlines() if "bronze-lines-" in x)
    assert "SKU" not in scan and "PaymentMethod" not in scan and "EmployeeID" not in scan


def test_exports_share_the_line_items(spark, data):
    shop = entry.Shop(spark, data)
    entry.export_rejects(shop)
    assert files(shop.lines, "line-items-") and not files(shop.lines, "bronze-lines-")


def test_margins_are_not_sorted(spark, data, monkeypatch):
    shop, sorted_columns = entry.Shop(spark, data), []
    number = gold.number_rows

    def seen(df, *args, **kwargs):
        sorted_columns.extend(df.columns)
        return number(df, *args, **kwargs)

    monkeypatch.setattr(gold, "number_rows", seen)
    table = shop.line_table
    margins = ["TotalProductionCost", "ContributionMargin", "ContributionMarginPercentage"]
    assert sorted_columns and not set(margins) & set(sorted_columns)
    key = ["InvoiceID", "Line", "DiscountID", *margins]
    assert table.select(*key).exceptAll(shop.lines.select(*key)).isEmpty()
    assert shop.lines.select(*key).exceptAll(table.select(*key)).isEmpty()
    assert table.columns == schemas.INVOICE_LINE_ITEMS.names


def test_refresh_reads_the_driving_input_once_to_compare_it(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(D(2024, 1, 5), 1), (None, 2)], "day date, n int")
    path = str(tmp_path / "t")

    def refresh(df):
        return versions.refresh_table(path, {"rows": (df, F.col("day"))}, lambda t: t["rows"], "day", "rows")

    monkeypatch.setattr(DataFrame, "distinct", lambda df: pytest.fail("another pass over the input"))
    assert refresh(rows).written == ["2024-01-01"]
    assert refresh(rows).written == []
    assert refresh(rows.filter("day IS NULL")).dropped == ["2024-01-01"]


def test_bronze_text_is_parsed_once(spark, tmp_path, monkeypatch):
    kept = flow.replace_table
    written = {}

    def replace(df, path, *args, **kwargs):
        written[path.rsplit("/", 1)[1]] = (files(df, "/bronze/"), df.columns)
        return kept(df, path, *args, **kwargs)

    monkeypatch.setattr(flow, "replace_table", replace)
    catalog = Catalog(str(tmp_path))
    full = ["1", *["x"] * 10, "1.5"]
    wrong = "\n".join(",".join(r) for r in (["y", *full[1:]], ["2"], ["", *full[1:]]))
    for name, text in BRONZE.items():
        (tmp_path / "bronze" / name).mkdir(parents=True)
        (tmp_path / "bronze" / name / "part.csv").write_text(text + (wrong if name == "products" else ""))
    report = {r.table_name: r.written_count for r in flow.run_silver(spark, catalog).collect()}
    assert (report["products"], report["rejected_products"], report["broken_products"]) == (2, 2, 1)
    assert not any(bronze for bronze, _ in written.values())
    assert written["broken_products"][1] == ["record", "values_found"]
    assert written["rejected_products"][1] == [*schemas.PRODUCTS.names, "missing_columns", "malformed_columns"]
