"""Dashboard reads: product sales, customer lookups and invoice history.

Search values are bound as literals, never spliced into query text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hemline import schemas
from hemline.operators.grouping import collapse


def product_sales(products: DataFrame, lines: DataFrame) -> DataFrame:
    """All products with quantity, revenue and buyers, best sold first.

    Lines collapse to (product, customer) before buyers are counted, so a
    product with very many lines is spread over its customers.
    """
    pairs = collapse(
        lines, ["ProductID", "CustomerID"],
        F.sum("Quantity").alias("_quantity"), F.sum("LineTotalUSD").alias("_revenue"),
    )
    sales = pairs.groupBy("ProductID").agg(
        F.sum("_quantity").alias("_quantity"),
        F.sum("_revenue").alias("_revenue"),
        F.count("CustomerID").alias("_buyers"),
    )
    return (
        products.join(sales, "ProductID", "left")
        .select(
            "ProductID", "Category", "SubCategory", "DescriptionEN", "Color", "Sizes",
            "ProductionCost",
            F.coalesce("_quantity", F.lit(0)).alias("TotalQuantitySold"),
            F.coalesce(F.col("_revenue"), F.lit(0)).alias("TotalRevenue"),
            F.coalesce("_buyers", F.lit(0)).alias("UniqueCustomers"),
        )
        .orderBy(F.desc("TotalQuantitySold"), "ProductID")
    )


def customer_by_id(customers: DataFrame, customer_id: int) -> DataFrame:
    return customers.filter(F.col("CustomerID") == customer_id)


def customers_by_name(
    customers: DataFrame, prefix: str, n: int = 20, case_sensitive: bool = False,
    collation: str | None = None,
) -> DataFrame:
    """The first ``n`` customers, by id, whose name starts with ``prefix``.

    With a collation, such as ``UNICODE_CI_AI`` for neither case nor accents, its rules decide
    what is equal, as a database's would, and ``case_sensitive`` is not asked.
    """
    name, start = F.col("Name"), F.lit(prefix)
    if collation is not None:
        name, start = F.collate(name, collation), F.collate(start, collation)
    elif not case_sensitive:
        name, start = F.lower(name), F.lower(start)
    return (
        customers.filter(F.startswith(name, start))
        .select("CustomerID", "Name", "Gender", "City", "Country")
        .orderBy("CustomerID")
        .limit(n)
    )


def customer_by_email(customers: DataFrame, email: str) -> DataFrame:
    return customers.filter(F.col("Email") == email).orderBy("CustomerID").limit(1)


def customer_by_phone(customers: DataFrame, phone: str) -> DataFrame:
    return customers.filter(F.col("Telephone") == phone).orderBy("CustomerID").limit(1)


def customer_invoices(invoices: DataFrame, customer_id: int) -> DataFrame:
    """A customer's invoices, latest first."""
    return (
        invoices.filter(F.col("CustomerID") == customer_id)
        .select(*schemas.INVOICE_FACT.names)
        .orderBy(F.desc("Date"), F.desc("Time"), "InvoiceID")
    )
