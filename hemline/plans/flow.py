"""The whole flow over stored tables: bronze CSV, silver, gold.

Each table is written once and read back by the jobs that need it, so no job
carries the lineage of the ones before it and a lost executor costs at most the
tasks it was running.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from hemline import schemas
from hemline.operators.joins import missing_rates
from hemline.operators.quality import is_rejected, judged_rows, key_violations
from hemline.operators.sketches import part_summaries
from hemline.plans import gold, reports, silver
from hemline.sources.delimited import RECORD, read_csv_text, values_found
from hemline.sources.staging import Scope, stage, table_bytes
from hemline.sources.tables import Catalog, Layout, extend_table, promote_table, read_table, write_mode
from hemline.sources.versions import Refresh, refresh_table, replace_table

#: Invoice columns whose summaries are kept by month.
SUMMARISED = ("InvoiceTotal", "InvoiceTotalUSD")
#: Columns by which dashboards look up one customer.
LOOKUP_COLUMNS = ("Email", "Telephone")
#: Files of the invoices, for a customer's history: a busy customer takes several files.
INVOICE_LAYOUT = Layout(range_by=("CustomerID", "Date", "InvoiceID"))


def customer_layout(spark: SparkSession, buckets: int | None = None, bloom: tuple[str, ...] = ()) -> Layout:
    """Files of the tables with one row per customer, all dealt alike so that they join as they lie."""
    return Layout(("CustomerID",), buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), bloom=bloom)


PROMOTED = ("discounts", "products", "employees")


def _report(checks: dict[str, DataFrame]) -> DataFrame:
    rows = [df.select(F.lit(name).alias("table_name"), "*") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, rows)


def run_silver(spark: SparkSession, catalog: Catalog,
               translations: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """Clean all bronze tables into silver; returns the write checks.

    Rows that lack a required value or hold a malformed one don't stop the run: they are
    stored as ``rejected_<table>``, with what is wrong, and reported; records with too few or
    too many fields as ``broken_<table>``, as they stand in the file. Silver is built whole
    from bronze, so a rerun replaces it; readers see the old tables until the new ones are checked.
    Customers lie in ``buckets`` files by CustomerID (as many as shuffle partitions unless given).
    """
    with Scope(spark):
        return _run_silver(spark, catalog, translations, buckets)


def _run_silver(spark: SparkSession, catalog: Catalog, translations: DataFrame | None,
                buckets: int | None) -> DataFrame:
    checks = {}

    def bronze(name: str) -> DataFrame:
        schema = schemas.BRONZE[name]
        text = read_csv_text(spark, catalog.bronze(name), schema, records=True)
        # three tables are made of it, and lines are read three times to tell copies: the text is parsed once
        judged = stage(judged_rows(text, schema, F.col(RECORD).alias("record"), values_found(text)), f"typed-{name}")
        whole = judged.filter("record IS NULL")
        checks[f"broken_{name}"] = replace_table(
            judged.filter("record IS NOT NULL").select("record", "values_found"),
            catalog.silver(f"broken_{name}"), catalog.fmt)
        checks[f"rejected_{name}"] = replace_table(
            whole.filter(is_rejected()).drop("record", "values_found"),
            catalog.silver(f"rejected_{name}"), catalog.fmt)
        return whole.filter(~is_rejected()).select(*schema.names)

    def write(name: str, clean: Callable[[DataFrame], DataFrame], layout: Layout | None = None) -> None:
        with Scope(spark):  # what a table is made of goes before the next one is begun
            conformed = gold.shaped(clean(bronze(name)), schemas.SILVER[name])
            checks[name] = replace_table(conformed, catalog.silver(name), catalog.fmt, layout=layout)

    write("employees", lambda rows: silver.employees(rows, translations))
    staff = read_table(spark, catalog.silver("employees"), schemas.EMPLOYEES, catalog.fmt)
    write("stores", lambda rows: silver.stores(rows, staff))
    write("customers", lambda rows: silver.customers(rows, translations), customer_layout(spark, buckets))
    write("products", silver.products)
    write("discounts", silver.discounts)
    write("transactions", silver.transactions)
    return _report(checks)


def refresh_invoices(path: str, transactions: DataFrame, stores: DataFrame, rates: DataFrame,
                     fmt: str = "parquet") -> Refresh:
    """Bring stored invoices up to date, month by month; an invoice's lines of one day are one row."""
    return refresh_table(
        path,
        {"transactions": (transactions, F.to_date("Timestamp")), "rates": (rates, F.col("RateDate")),
         "stores": (stores, None)},
        lambda t: gold.invoice_fact(t["transactions"], t["stores"], t["rates"]), "Date", "transactions", fmt)


def refresh_summaries(path: str, invoices: DataFrame, fmt: str = "parquet") -> Refresh:
    """Bring stored summaries of invoice totals up to date; only months that changed are read for them again."""
    def build(t):
        monthly = t["invoices"].withColumn("Month", F.to_date(F.trunc("Date", "month")))
        return part_summaries(monthly, "Month", *SUMMARISED)

    return refresh_table(path, {"invoices": (invoices, F.col("Date"))}, build, "Month", "invoices", fmt)


def run_gold(spark: SparkSession, catalog: Catalog, feed: DataFrame, first_day: datetime.date,
             last_day: datetime.date, as_of: datetime.date | None = None,
             match: str = "all", environment: str = "dev", buckets: int | None = None) -> DataFrame:
    """Build all gold tables from silver; returns the write checks.

    Where the environment's write mode is overwrite, every table is built whole. Where it
    is append, invoices are refreshed: only months whose lines, stores or rates changed are
    built again, and months that came are added. Line items are numbered over the whole table
    and customers and stores summed over all lines, so these are always built whole; appending
    to them would count each line again. Rates are kept: months that are not stored yet are
    built from ``feed`` and added. Lines that share invoice, number and promotion are stored
    as ``key_violations``, with how many they are, and reported. Months and
    currencies without a rate, whose amounts stay as they are, are stored as
    ``missing_rates`` and reported. ``match="first"`` gives each line one promotion at
    most. Without ``as_of`` ages and recency count to the month after the last line. Customers
    and their metrics lie in ``buckets`` files by CustomerID, as in silver, and are joined without
    an exchange; invoices written whole are sorted by customer.
    """
    with Scope(spark):
        return _run_gold(spark, catalog, feed, first_day, last_day, as_of, match, environment, buckets)


def _run_gold(spark: SparkSession, catalog: Catalog, feed: DataFrame, first_day: datetime.date,
              last_day: datetime.date, as_of: datetime.date | None, match: str, environment: str,
              buckets: int | None) -> DataFrame:
    checks = {}

    def stored(name: str, *bare: str) -> DataFrame:
        return read_table(spark, catalog.silver(name), schemas.SILVER[name], catalog.fmt, bare)

    def write(name: str, build: Callable[[], DataFrame], layout: Layout | None = None) -> DataFrame:
        with Scope(spark):  # what a table is made of goes before the next one is begun
            checks[name] = replace_table(build(), catalog.gold(name), catalog.fmt, layout=layout)
        return read_table(spark, catalog.gold(name), fmt=catalog.fmt)

    bounds = spark.range(1).select(
        F.lit(first_day).alias("first_day"), F.lit(last_day).alias("last_day")
    )
    rates = extend_table(
        spark, catalog.gold("exchange_rates"), gold.exchange_rates(gold.month_spine(bounds), feed),
        ["RateDate", "BaseCurrency", "TargetCurrency"], schemas.EXCHANGE_RATES, catalog.fmt,
    )
    sales, stores, products = stored("transactions"), stored("stores"), stored("products")
    if write_mode(environment) == "append":
        refresh_invoices(catalog.gold("invoice_fact"), sales, stores, rates, catalog.fmt)
        invoices = read_table(spark, catalog.gold("invoice_fact"), fmt=catalog.fmt)
    else:
        invoices = write("invoice_fact", lambda: gold.invoice_fact(sales, stores, rates), INVOICE_LAYOUT)
    refresh_summaries(catalog.gold("invoice_summaries"), invoices, catalog.fmt)
    write("missing_rates", lambda: missing_rates(invoices, rates))
    lines = write("invoice_line_items", lambda: _line_table(gold.line_items(
        sales, stores, products, stored("discounts"), rates, gold.line_span(sales), match)))
    write("key_violations", lambda: key_violations(lines, *gold.LINE_ORDER))
    for name in PROMOTED:
        promote_table(spark, catalog.silver(name), catalog.gold(name), schemas.SILVER[name],
                      fmt=catalog.fmt)
    write("stores", lambda: gold.gold_stores(stores, gold.store_metrics(lines)))
    metrics = write("customer_metrics", lambda: gold.customer_metrics(lines), customer_layout(spark, buckets))
    day = None if as_of is None else F.lit(as_of)
    people = write("customers", lambda: gold.gold_customers(stored("customers", "CustomerID"), metrics, day),
                   customer_layout(spark, buckets, LOOKUP_COLUMNS))
    write("segment_metrics", lambda: reports.segment_metrics(people))
    return _report(checks)


#: Bytes of staged line items that are sorted at a time; their shuffle takes three to four times as many.
SORTED_BYTES = 2 << 30


def _line_table(lines: DataFrame) -> DataFrame:
    """``gold.numbered_table`` with its joins' shuffles and its sort's on disk one after the other.

    The joined lines are staged, so what was exchanged to join them goes before they are sorted,
    and sorted in slices of SORTED_BYTES, whose shuffles go one by one.
    """
    spark = lines.sparkSession
    with Scope(spark) as scope:
        joined = stage(lines.drop(*gold.MARGIN), "unnumbered")
        return scope.keep(gold.numbered_table(joined, -(-table_bytes(joined) // SORTED_BYTES)))
