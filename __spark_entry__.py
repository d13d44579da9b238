"""Registered queries, their SQL counterparts, and the flagship query."""

from __future__ import annotations

import importlib.util
import os
import sys
import uuid
from collections.abc import Callable
from functools import cached_property, reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession, functions as F  # noqa: E402

from hemline import schemas  # noqa: E402
from hemline.functions import lookups as L  # noqa: E402
from hemline.functions.phone import phone_shape  # noqa: E402
from hemline.functions.text import default_nulls, standardize_columns  # noqa: E402
from hemline.operators import joins, quality, sketches  # noqa: E402
from hemline.plans import flow, gold, lookups, reports, silver  # noqa: E402
from hemline.sources import delimited, star_retail, tables, versions  # noqa: E402
from hemline.sources.serving import fitting_rows, rejected_values  # noqa: E402
from hemline.sources.staging import stage, staging_root  # noqa: E402
from oracles.sql import ORACLES  # noqa: E402


class Shop:
    """The layered tables of one data folder, each built when first used.

    Small tables that several joins read (rates, numbered promotions) and the
    per-customer figures are staged, as stored tables would be; everything else
    is lazy.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def bronze(self, name: str) -> DataFrame:
        return getattr(star_retail, name)(self.spark, self.folder)

    def path(self, label: str) -> str:
        return f"{staging_root(self.spark)}/{label}-{uuid.uuid4().hex}"

    @cached_property
    def translations(self) -> DataFrame:
        return self.bronze("translations")

    @cached_property
    def transactions(self) -> DataFrame:
        lines = self.bronze("transactions")
        return silver.transactions(lines, quality.repeat_filter(lines, *silver.LINE_KEY))

    @cached_property
    def span(self) -> DataFrame:
        """First and last day of the lines, from the orders alone."""
        return self.bronze("month_bounds")

    @cached_property
    def days(self) -> DataFrame:
        return self.bronze("transactions").select(F.to_date("Timestamp").alias("Date"))

    @cached_property
    def customers(self) -> DataFrame:
        return silver.customers(self.bronze("customers"), self.translations)

    @cached_property
    def employees(self) -> DataFrame:
        return silver.employees(self.bronze("employees"), self.translations)

    @cached_property
    def stores(self) -> DataFrame:
        return silver.stores(self.bronze("stores"), self.employees)

    @cached_property
    def places(self) -> DataFrame:
        """Stores without the employee count, all the line items need."""
        return silver.name_stores(self.bronze("stores"))

    @cached_property
    def products(self) -> DataFrame:
        return silver.products(self.bronze("products"))

    @cached_property
    def discounts(self) -> DataFrame:
        # numbering stages it, so the joins know its size
        return silver.discounts(self.bronze("discounts"))

    @cached_property
    def rates(self) -> DataFrame:
        spine = gold.month_spine(self.bronze("month_bounds"))
        return stage(gold.exchange_rates(spine, self.bronze("rates_feed")), "rates")

    @cached_property
    def invoices(self) -> DataFrame:
        return gold.invoice_fact(self.transactions, self.places, self.rates)

    @cached_property
    def line_dims(self) -> DataFrame:
        return gold.line_items_with_dimensions(self.transactions, self.places, self.products)

    @cached_property
    def lines(self) -> DataFrame:
        """Line items as the reports read them, without places."""
        return gold.line_items(
            self.transactions, None, self.products, self.discounts, self.rates, self.span
        )

    @cached_property
    def line_table(self) -> DataFrame:
        return gold.invoice_line_items(
            self.transactions, self.places, self.products, self.discounts, self.rates, self.span)

    @cached_property
    def metrics(self) -> DataFrame:
        return stage(gold.customer_metrics(self.lines), "customer-metrics")

    @cached_property
    def as_of(self) -> Column:
        return gold.as_of_date(self.metrics, "LastActivityDate").scalar()

    @cached_property
    def enriched(self) -> DataFrame:
        return gold.enrich_spending(self.customers, self.metrics)

    @cached_property
    def rfm(self) -> DataFrame:
        return gold.customer_rfm(self.enriched, self.as_of)

    @cached_property
    def gold_customers(self) -> DataFrame:
        return gold.gold_customers(self.customers, self.metrics)

    @cached_property
    def store_metrics(self) -> DataFrame:
        return gold.store_metrics(self.lines)

    @cached_property
    def gold_stores(self) -> DataFrame:
        return gold.gold_stores(self.stores, self.store_metrics)


class StagedShop(Shop):
    """The same tables for the registered queries, which read the lines whole.

    Lines are read three times to tell copies, so the bronze lines are staged: they are joined
    with their orders once, and what reads them reads its own columns of the staged table.
    """

    @cached_property
    def transactions(self) -> DataFrame:
        return silver.transactions(stage(self.bronze("transactions"), "bronze-lines"))


# --- sources, sinks, schema ----------------------------------------------

def csv_roundtrip(t: Shop) -> DataFrame:
    path = t.path("customers-csv")
    delimited.write_csv(t.bronze("customers"), path)
    return delimited.read_csv(t.spark, path, schemas.CUSTOMERS)


def enforce_schema(t: Shop) -> DataFrame:
    raw = t.bronze("products")
    return quality.enforce_schema(raw.select(*[F.col(c).cast("string") for c in raw.columns]),
                                  schemas.PRODUCTS)


def nameless_customers(t: Shop) -> DataFrame:
    """Customers whose fixed-form names are missing, for the required-column rules."""
    name = F.when(F.col("Name").startswith("Customer#"), None).otherwise(F.col("Name"))
    return t.bronze("customers").withColumn("Name", name)


def conforming_rows(t: Shop) -> DataFrame:
    return quality.conforming_rows(nameless_customers(t), schemas.CUSTOMERS)


def rejected_rows(t: Shop) -> DataFrame:
    return quality.rejected_rows(nameless_customers(t), schemas.CUSTOMERS).select(
        "CustomerID", "missing_columns"
    )


def table_roundtrip(t: Shop) -> DataFrame:
    path = t.path("products")
    tables.write_table(t.products, path)
    return tables.read_table(t.spark, path, schemas.PRODUCTS)


def promote_table(t: Shop) -> DataFrame:
    source, target = t.path("silver-employees"), t.path("gold-employees")
    tables.write_table(t.employees, source)
    return tables.promote_table(t.spark, source, target, schemas.EMPLOYEES)


def twice(t: Shop) -> DataFrame:
    """Every transaction two times, for the duplicate operators."""
    rows = t.bronze("transactions")
    return rows.unionByName(rows)


def discount_pattern_check(t: Shop) -> DataFrame:
    # the adapter's store-wide promotions use its two highest values
    return quality.store_wide_rule(t.bronze("discounts"), (0.09, 0.1))


def translated(t: Shop) -> DataFrame:
    df = silver.translate_places(silver.clean_names(t.bronze("customers")))
    return joins.translate_names(df, t.translations, F.col("Country") == L.CHINESE_COUNTRY)


def phones(t: Shop) -> DataFrame:
    return silver.clean_phones(silver.translate_places(t.bronze("customers")))


def usd_lines(t: Shop) -> DataFrame:
    return joins.to_usd(t.line_dims, t.rates, "LineTotal", "LineTotalUSD")


def rates_extended(t: Shop) -> DataFrame:
    """Rates stored for the months before 1995, then extended by those that are missing."""
    path = t.path("rates")
    tables.write_table(t.rates.filter("RateDate < DATE'1995-01-01'"), path)
    return tables.extend_table(t.spark, path, t.rates, ["RateDate", "BaseCurrency", "TargetCurrency"],
                               schemas.EXCHANGE_RATES)


def invoice_fact_incremental(t: Shop) -> DataFrame:
    """Invoices stored without the lines from 1998 on, then brought up to date month by month."""
    path = t.path("invoice-fact")
    early = t.transactions.filter("Timestamp < TIMESTAMP'1998-01-01'")
    flow.refresh_invoices(path, early, t.places, t.rates)
    flow.refresh_invoices(path, t.transactions, t.places, t.rates)
    return tables.read_table(t.spark, path)


def gold_customers_bucketed(t: Shop) -> DataFrame:
    """Gold customers from customers and metrics that are stored in buckets alike."""
    layout = flow.customer_layout(t.spark)
    people, metrics = t.path("silver-customers"), t.path("customer-metrics")
    versions.replace_table(gold.shaped(t.customers, schemas.CUSTOMERS), people, layout=layout)
    versions.replace_table(gold.customer_metrics(t.lines), metrics, layout=layout)
    return gold.gold_customers(
        tables.read_table(t.spark, people, schemas.CUSTOMERS, bare=("CustomerID",)),
        tables.read_table(t.spark, metrics))


def stored_customer_lookups(t: Shop) -> DataFrame:
    """One customer by id, one by mail and one by telephone, from the stored gold table."""
    path = t.path("gold-customers")
    versions.replace_table(t.gold_customers, path,
                           layout=flow.customer_layout(t.spark, bloom=flow.LOOKUP_COLUMNS))
    people = tables.read_table(t.spark, path)
    found = {
        "id": lookups.customer_by_id(people, 42),
        "email": lookups.customer_by_email(people, "user43@example.com"),
        "phone": lookups.customer_by_phone(people, "+333315"),
    }
    return reduce(DataFrame.unionByName, [df.withColumn("Lookup", F.lit(by)) for by, df in found.items()])


def stored_customer_invoices(t: Shop) -> DataFrame:
    """A customer's invoices from the stored table, which is sorted by customer."""
    path = t.path("invoice-fact")
    versions.replace_table(t.invoices, path, layout=flow.INVOICE_LAYOUT)
    return lookups.customer_invoices(tables.read_table(t.spark, path), 42)


def customers_by_name_ci_ai(t: Shop) -> DataFrame:
    """Names with accents in every second row, found by a prefix without any."""
    accented = F.when(F.col("CustomerID") % 2 == 0, F.translate("Name", "An", "Áñ")).otherwise(F.col("Name"))
    return lookups.customers_by_name(
        t.customers.withColumn("Name", accented), "aNN", collation="UNICODE_CI_AI")


def spending_summary_merged(t: Shop) -> DataFrame:
    """Summaries stored for the months before 1998, brought up to date, merged and held against the rows."""
    path, invoices = t.path("invoice-summaries"), stage(t.invoices, "invoices")
    flow.refresh_summaries(path, invoices.filter("Date < DATE'1998-01-01'"))
    flow.refresh_summaries(path, invoices)
    merged = stage(sketches.merged_summary(tables.read_table(t.spark, path), *flow.SUMMARISED), "merged")
    # three times the bound that one quantile keeps in 99 of 100 sketches
    checks = reduce(DataFrame.unionByName, [
        sketches.quartiles_within(invoices, merged, c, 3 * sketches.rank_error()) for c in flow.SUMMARISED])
    figures = ("mean", "stddev", "min", "max")
    return merged.select("metric", "count", *[F.round(c, 2).alias(c) for c in figures]).join(checks, "metric")


def load_or_build(t: Shop) -> DataFrame:
    """Products built and stored by the first call, read by the second, which must not build."""
    path = t.path("products")
    tables.load_or_build(t.spark, path, lambda: t.products, schemas.PRODUCTS)
    return tables.load_or_build(t.spark, path, lambda: t.products.limit(0), schemas.PRODUCTS)


def flow_report(t: Shop) -> DataFrame:
    """The whole stored flow: bronze tables as CSV, silver, gold, and the write checks of both."""
    catalog = tables.Catalog(t.path("lake"))
    for name in schemas.BRONZE:
        delimited.write_csv(t.bronze(name), catalog.bronze(name))
    first, last = t.bronze("month_bounds").select("first_day", "last_day").first()
    done = flow.run_silver(t.spark, catalog, t.translations).withColumn("layer", F.lit("silver"))
    more = flow.run_gold(t.spark, catalog, t.bronze("rates_feed"), first, last).withColumn("layer", F.lit("gold"))
    # months with a rate of their own are not all in the feed: what is missing is another query's matter
    return done.unionByName(more)


def csv_rejects(t: Shop) -> DataFrame:
    """Records of customers as lines of text, some with a field too many, some cut short."""
    path, k = t.path("customer-lines"), F.col("CustomerID")
    line = F.concat_ws(",", k.cast("string"), F.col("Email"), F.col("Gender"), F.col("DateOfBirth").cast("string"))
    kept = t.bronze("customers").filter("Email IS NOT NULL AND DateOfBirth IS NOT NULL")
    kept.select(F.when(k % 37 == 0, F.concat(line, F.lit(",more"))).when(
        k % 41 == 0, F.concat_ws(",", k.cast("string"), "Email")).otherwise(line)).write.text(path)
    layout = schemas._layout("CustomerID", CustomerID="integer", Email="string", Gender="string", DateOfBirth="date")
    return delimited.broken_records(delimited.read_csv_text(t.spark, path, layout, header=False, records=True))


def malformed_customers(t: Shop) -> DataFrame:
    """Customers as text, some with an id that is no number or a day that is none."""
    text = t.bronze("customers")
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    k = F.col("CustomerID").cast("int")
    return text.withColumns({
        "DateOfBirth": F.when(k % 29 == 0, F.concat(F.lit("day "), "CustomerID")).otherwise(F.col("DateOfBirth")),
        "CustomerID": F.when(k % 31 == 0, F.concat(F.lit("C-"), "CustomerID")).otherwise(F.col("CustomerID")),
    })


#: The gold table behind each serving table.
SERVED: dict[str, str] = {
    "customers": "gold_customers", "discounts": "discounts", "employees": "employees",
    "exchange_rates": "rates", "invoice_fact": "invoices", "invoice_line_items": "line_table",
    "products": "products", "stores": "gold_stores",
}


def export_rejects(t: Shop) -> DataFrame:
    # customers, stores and the line table are made of the same line items
    t.lines = stage(t.lines, "line-items")
    t.line_table = gold.placed_table(t.lines, t.places)
    return reduce(DataFrame.unionByName,
                  [rejected_values(getattr(t, source), name) for name, source in SERVED.items()])


def sql_over_tables(t: Shop) -> DataFrame:
    """SQL text over DataFrames, with bound values and no global view names."""
    return t.spark.sql(
        """SELECT l.Country, s.NumberOfEmployees, count(*) AS LineCount
           FROM {lines} l LEFT JOIN {stores} s ON l.StoreID = s.StoreID
           WHERE l.TransactionType = :kind GROUP BY l.Country, s.NumberOfEmployees""",
        args={"kind": "Return"}, lines=t.line_dims, stores=t.stores)


def rounded(df: DataFrame) -> DataFrame:
    """Statistics to two decimals."""
    return df.select("statistic", *[F.round(c, 2).alias(c) for c in df.columns[1:]])


QUERIES: dict[str, Callable[[Shop], DataFrame]] = {
    # sources, sinks, schema
    "csv_roundtrip": csv_roundtrip,
    "enforce_schema": enforce_schema,
    "conforming_rows": conforming_rows,
    "rejected_rows": rejected_rows,
    "describe_table": lambda t: quality.describe_table(t.bronze("customers")),
    "table_roundtrip": table_roundtrip,
    "verify_roundtrip": lambda t: tables.write_verified(t.customers, t.path("customers")),
    "promote_table": promote_table,
    "export_mapping": lambda t: fitting_rows(t.invoices, "invoice_fact"),
    "export_rejects": export_rejects,
    "malformed_conforming": lambda t: quality.conforming_rows(malformed_customers(t), schemas.CUSTOMERS),
    "malformed_rejected": lambda t: quality.rejected_rows(malformed_customers(t), schemas.CUSTOMERS).select(
        "Email", "missing_columns", "malformed_columns"),
    "sample_rows": lambda t: quality.sample_rows(
        t.transactions.select("InvoiceID", "Line", "ProductID", "LineTotal"), 5,
        "InvoiceID", "Line"),
    "sql_over_tables": sql_over_tables,
    # profiles and checks
    "null_profile": lambda t: quality.null_profile(t.bronze("customers")),
    "null_nan_profile": lambda t: quality.null_nan_profile(t.bronze("transactions")),
    "duplicate_rows": lambda t: quality.duplicate_rows(twice(t)),
    "duplicate_keys": lambda t: quality.duplicate_keys(
        t.spark.read.parquet(f"{t.folder}/lineitem.parquet"), "l_orderkey", "l_linenumber"),
    "dedup_transactions": lambda t: quality.drop_duplicate_rows(twice(t)).select(
        "InvoiceID", "Line", "SKU", "LineTotal"),
    "dedup_by_key": lambda t: quality.drop_duplicate_rows(t.bronze("transactions"), *silver.LINE_KEY).select(
        "InvoiceID", "Line", "SKU", "LineTotal"),
    "key_violations": lambda t: quality.key_violations(
        t.spark.read.parquet(f"{t.folder}/lineitem.parquet"), "l_orderkey", "l_linenumber"),
    "gold_key_violations": lambda t: quality.key_violations(
        stage(t.lines.select(*gold.LINE_ORDER), "line-keys"), *gold.LINE_ORDER),
    "csv_rejects": csv_rejects,
    "load_or_build": load_or_build,
    "flow_report": flow_report,
    "check_emails": lambda t: quality.check_emails(t.bronze("customers")),
    "check_phone_prefix": lambda t: quality.check_phone_prefix(t.customers),
    "country_distribution": lambda t: quality.value_counts(t.bronze("stores"), "Country"),
    "phone_pattern_counts": lambda t: quality.value_counts(
        t.bronze("customers").select(phone_shape(F.col("Telephone")).alias("PhonePattern")),
        "PhonePattern"),
    "phone_patterns": lambda t: t.bronze("customers").select(
        "CustomerID", phone_shape(F.col("Telephone")).alias("PhonePattern")),
    "phone_chars": lambda t: quality.non_digit_characters(t.bronze("customers"), "Telephone"),
    "phone_extra_chars": lambda t: quality.extra_characters(phones(t), "Telephone"),
    "discount_date_range": lambda t: quality.column_range(t.bronze("discounts"), "StartDate"),
    "discount_pattern_check": discount_pattern_check,
    "null_size_subcategories": lambda t: quality.distinct_values(
        t.bronze("products").filter("Sizes IS NULL"), "SubCategory"),
    "distinct_jobtitles": lambda t: quality.distinct_count(t.customers, "JobTitle"),
    # cleaning
    "default_nulls": lambda t: default_nulls(
        t.bronze("transactions").select("InvoiceID", "Line", "Color", "Size"),
        {"Color": L.NO_VALUE, "Size": L.NO_SIZE}),
    "replace_values": lambda t: silver.rename_children_range(t.bronze("products")).select(
        "ProductID", "SubCategory"),
    "standardize_text": lambda t: standardize_columns(
        t.bronze("products").select("ProductID", "Category", "SubCategory", "Color"),
        ["Category", "SubCategory", "Color"]),
    "clean_names": lambda t: silver.clean_names(t.bronze("customers")).select(
        "CustomerID", "Name"),
    "translate_geo": lambda t: silver.translate_places(t.bronze("customers")).select(
        "CustomerID", "Country", "City"),
    "translate_store_names": lambda t: t.places.select("StoreID", "StoreName", "City"),
    "names_to_translate": lambda t: joins.names_to_translate(
        silver.translate_places(silver.clean_names(t.bronze("customers"))),
        F.col("Country") == L.CHINESE_COUNTRY),
    "translate_names": lambda t: translated(t).select("CustomerID", "Country", "Name"),
    "untranslated_names": lambda t: quality.untranslated(
        translated(t), F.col("Country") == L.CHINESE_COUNTRY).select("CustomerID", "Name"),
    "clean_phones": lambda t: phones(t).select("CustomerID", "Telephone"),
    "normalize_phones": lambda t: silver.add_dial_codes(phones(t)).select(
        "CustomerID", "Country", "Telephone"),
    "filter_sales": lambda t: t.transactions.filter(gold.IS_SALE).select(
        "InvoiceID", "Line", "TransactionType", "LineTotal"),
    "employee_discrepancies": lambda t: silver.employee_discrepancies(t.places, t.employees),
    "employee_reconcile": lambda t: t.stores.select("StoreID", "NumberOfEmployees"),
    "discount_ids": lambda t: t.discounts.select(
        "DiscountID", "Discount", "StartDate", "EndDate", "Category", "SubCategory"),
    # silver jobs
    "silver_customers": lambda t: t.customers,
    "silver_employees": lambda t: t.employees,
    "silver_products": lambda t: t.products,
    "silver_discounts": lambda t: t.discounts,
    "silver_stores": lambda t: t.stores,
    "silver_transactions": lambda t: t.transactions,
    # gold: rates, invoices, lines
    "exchange_rates": lambda t: t.rates,
    "rates_extended": rates_extended,
    "invoice_fact": lambda t: t.invoices,
    "invoice_fact_incremental": invoice_fact_incremental,
    "fx_invoice": lambda t: t.invoices.select(
        "InvoiceID", "Date", "Currency", "InvoiceTotal", "InvoiceTotalUSD"),
    "fx_missing": lambda t: joins.missing_rates(t.line_dims, t.rates),
    "line_items_dims": lambda t: t.line_dims.select(
        "InvoiceID", "Line", "ProductID", "Category", "SubCategory", "StoreID", "Country", "City"),
    "fx_line": lambda t: usd_lines(t).select(
        "InvoiceID", "Line", "Date", "Currency", "LineTotal", "LineTotalUSD"),
    "discount_match": lambda t: joins.match_discounts(t.line_dims, t.discounts, t.span),
    "discount_attach": lambda t: joins.attach_discounts(t.line_dims, t.discounts, t.span).select(
        "InvoiceID", "Line", "TransactionType", "Discount", "Date", "Category", "SubCategory",
        "DiscountID"),
    "discount_attach_first": lambda t: joins.attach_discounts(
        t.line_dims, t.discounts, t.span, match="first").select("InvoiceID", "Line", "DiscountID"),
    "line_item_ids": lambda t: gold.number_line_items(
        joins.attach_discounts(t.line_dims, t.discounts, t.span).select(*gold.LINE_ORDER)),
    "margin_lines": lambda t: gold.with_margin(usd_lines(t)).select(
        "InvoiceID", "Line", "TransactionType", "Quantity", "LineTotalUSD", "ProductionCost",
        "TotalProductionCost", "ContributionMargin", "ContributionMarginPercentage"),
    "invoice_line_items": lambda t: t.line_table,
    # gold: customers
    "as_of_date": lambda t: gold.as_of_date(t.days),
    "age_groups": lambda t: gold.with_age(t.customers, gold.as_of_date(t.days).scalar()).select(
        "CustomerID", "DateOfBirth", "Age", "AgeGroup"),
    "parent_customers": lambda t: gold.parent_customers(t.lines),
    "customer_spending": lambda t: gold.customer_spending(t.lines),
    "customer_last_purchase": lambda t: gold.customer_last_purchase(t.lines),
    "customer_metrics": lambda t: gold.customer_metrics(t.lines),
    "customer_spending_enriched": lambda t: gold.enrich_spending(
        t.customers, gold.customer_metrics(t.lines)).select(
        "CustomerID", "IsParent", "TotalSpending", "NoOfInvoices", "AverageSpending"),
    "spending_summary": lambda t: rounded(quality.summary_table(
        t.enriched, "TotalSpending", "NoOfInvoices", "AverageSpending")),
    "spending_summary_merged": spending_summary_merged,
    "gold_customers_bucketed": gold_customers_bucketed,
    "customer_rfm": lambda t: t.rfm,
    "rfm_scores": lambda t: gold.rfm_scores(t.rfm),
    "rfm_table": lambda t: gold.rfm_table(t.rfm),
    "rfm_segments": lambda t: gold.rfm_segments(t.rfm).select(
        "CustomerID", "RFM_Score", "RFM_Segment"),
    "gold_customers": lambda t: t.gold_customers,
    # gold: stores
    "store_metrics": lambda t: t.store_metrics,
    "gold_stores": lambda t: t.gold_stores,
    "store_summary": lambda t: rounded(quality.summary_table(
        t.gold_stores, "TotalSalesUSD", "AverageMonthlyUSD", "TotalTransactions", "ReturnRate")),
    # reports
    "discount_status": lambda t: reports.discount_status(t.lines),
    "discount_usage": lambda t: reports.discount_usage(t.discounts, t.lines),
    "discount_usage_top": lambda t: reports.discount_usage(t.discounts, t.lines, top=10),
    "margin_overall": lambda t: reports.margin_overall(t.lines),
    "margin_by_category": lambda t: reports.margin_by_category(t.lines),
    "margin_by_discount": lambda t: reports.margin_by_discount(t.lines),
    "margin_buckets": lambda t: reports.margin_buckets(t.lines),
    "rfm_distribution": lambda t: quality.value_counts(gold.rfm_segments(t.rfm), "RFM_Segment"),
    "age_distribution": lambda t: reports.age_distribution(t.gold_customers),
    "age_spending": lambda t: reports.age_spending(t.gold_customers),
    "segments_by_age": lambda t: reports.segments_by_age(t.gold_customers),
    "segments_by_country": lambda t: reports.segments_by_country(t.gold_customers),
    "segment_metrics": lambda t: reports.segment_metrics(t.gold_customers),
    "stores_by_country": lambda t: reports.stores_by_country(t.gold_stores),
    "store_ranking": lambda t: reports.store_ranking(t.gold_stores),
    "underperforming_stores": lambda t: reports.underperforming_stores(t.gold_stores),
    # dashboard reads
    "product_sales": lambda t: lookups.product_sales(t.products, t.lines),
    "customer_by_id": lambda t: lookups.customer_by_id(t.customers, 42),
    "customer_by_email": lambda t: lookups.customer_by_email(t.customers, "user43@example.com"),
    "customer_by_phone": lambda t: lookups.customer_by_phone(t.customers, "+333315"),
    "customers_by_name": lambda t: lookups.customers_by_name(t.customers, "ann"),
    "customers_by_name_ci_ai": customers_by_name_ci_ai,
    "stored_customer_lookups": stored_customer_lookups,
    "stored_customer_invoices": stored_customer_invoices,
    "customer_invoices": lambda t: lookups.customer_invoices(t.invoices, 42),
}

QUERIES |= {f"export_{name}": lambda t, name=name, source=source: fitting_rows(getattr(t, source), name)
            for name, source in SERVED.items()}


def _comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and timestamps as text, which every engine hands out alike."""

    def column(name: str, kind: str) -> Column:
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if kind.startswith("timestamp"):
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        return F.col(name)

    return df.select(*[column(name, kind) for name, kind in df.dtypes])


def _registered(build: Callable[[Shop], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _comparable(build(StagedShop(spark, folder.rstrip("/"))))


def _there(module: str) -> bool:
    """Whether the module's file is there; one that is but fails to import is an error."""
    spec = importlib.util.find_spec(module)
    return spec is not None and spec.origin is not None


LLM_QUERIES, LLM_ORACLES = {}, {}
# the operators for training data live in folders of their own and may be left out
if _there("corpus_pipeline") and _there("hemline.llm"):
    import corpus_pipeline
    from hemline.llm.entry import QUERIES as LLM_QUERIES
    from hemline.llm.oracles import ORACLES as LLM_ORACLES

    LLM_QUERIES = LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        LLM_ORACLES = LLM_ORACLES | {"pipeline": corpus_pipeline.ORACLE_SQL}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: contribution margin by product category."""
    return queries()["margin_by_category"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _registered(build) for name, build in QUERIES.items()} | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLES | LLM_ORACLES
