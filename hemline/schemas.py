"""Table layouts of the bronze, silver and gold layers.

Fixed values: column names, order, types and required columns are the data
contract and are stated as they are.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

MONEY = "decimal(10,4)"


def _layout(required: str, **columns: str) -> StructType:
    mandatory = set(required.split())
    out = StructType()
    for name, kind in columns.items():
        out = out.add(name, kind, name not in mandatory)
    return out


# --- bronze ---------------------------------------------------------------

STORES = _layout(
    "StoreID",
    StoreID="integer", Country="string", City="string", StoreName="string",
    NumberOfEmployees="integer", ZIPCode="string",
    Latitude="decimal(10,6)", Longitude="decimal(10,6)",
)

EMPLOYEES = _layout(
    "EmployeeID Name",
    EmployeeID="integer", StoreID="integer", Name="string", Position="string",
)

PRODUCTS = _layout(
    "ProductID",
    ProductID="integer", Category="string", SubCategory="string",
    DescriptionPT="string", DescriptionDE="string", DescriptionFR="string",
    DescriptionES="string", DescriptionEN="string", DescriptionZH="string",
    Color="string", Sizes="string", ProductionCost=MONEY,
)

DISCOUNTS = _layout(
    "",
    StartDate="date", EndDate="date", Discount="decimal(10,2)",
    Description="string", Category="string", SubCategory="string",
)

CUSTOMERS = _layout(
    "CustomerID Name",
    CustomerID="integer", Name="string", Email="string", Telephone="string",
    City="string", Country="string", Gender="string", DateOfBirth="date",
    JobTitle="string",
)

TRANSACTIONS = _layout(
    "InvoiceID",
    InvoiceID="string", Line="integer", CustomerID="integer",
    ProductID="integer", Size="string", Color="string", UnitPrice=MONEY,
    Quantity="integer", Timestamp="timestamp", Discount="decimal(10,2)",
    LineTotal=MONEY, StoreID="integer", EmployeeID="integer",
    Currency="string", CurrencySymbol="string", SKU="string",
    TransactionType="string", PaymentMethod="string", InvoiceTotal=MONEY,
)

# --- silver (where it differs from bronze) --------------------------------

SILVER_DISCOUNTS = _layout(
    "DiscountID",
    StartDate="date", EndDate="date", DiscountID="integer",
    Discount="decimal(10,2)", Description="string", Category="string",
    SubCategory="string",
)

# --- gold -----------------------------------------------------------------

# The rate is held as a decimal so that converted money never depends on the
# order in which doubles are multiplied.
EXCHANGE_RATES = _layout(
    "RateDate BaseCurrency TargetCurrency ExchangeRate",
    RateDate="date", BaseCurrency="string", TargetCurrency="string",
    ExchangeRate="decimal(18,8)",
)

INVOICE_FACT = _layout(
    "InvoiceID",
    InvoiceID="string", CustomerID="integer", Date="date", Time="string",
    StoreID="integer", StoreCountry="string", StoreCity="string",
    EmployeeID="integer", TotalQuantity="integer", Currency="string",
    CurrencySymbol="string", TransactionType="string", PaymentMethod="string",
    InvoiceTotal=MONEY, InvoiceTotalUSD=MONEY,
)

# LineItemID is a long: a 32-bit surrogate key ends at 2.1 billion lines.
# The serving layout narrows it with a range check.
INVOICE_LINE_ITEMS = _layout(
    "LineItemID InvoiceID",
    LineItemID="long", InvoiceID="string", Line="integer",
    CustomerID="integer", ProductID="integer", Category="string",
    SubCategory="string", StoreID="integer", Country="string", City="string",
    Size="string", Color="string", UnitPrice=MONEY, Quantity="integer",
    Discount="decimal(10,2)", DiscountID="integer", SKU="string", Date="date",
    TransactionType="string", LineTotal=MONEY, LineTotalUSD=MONEY,
    ProductionCost=MONEY, TotalProductionCost=MONEY, ContributionMargin=MONEY,
    ContributionMarginPercentage="decimal(10,2)",
)

GOLD_CUSTOMERS = _layout(
    "CustomerID Name",
    CustomerID="integer", Name="string", Email="string", Telephone="string",
    City="string", Country="string", Gender="string", DateOfBirth="date",
    JobTitle="string", Age="integer", AgeGroup="string", IsParent="boolean",
    TotalSpending="decimal(20,4)", NoOfInvoices="integer",
    AverageSpending="decimal(14,4)", RFM_Segment="string", Recency="integer",
)

GOLD_STORES = _layout(
    "StoreID",
    StoreID="integer", Country="string", City="string", StoreName="string",
    NumberOfEmployees="integer", ZIPCode="string", Latitude="decimal(10,6)",
    Longitude="decimal(10,6)", TotalSalesUSD="decimal(24,4)",
    TotalTransactions="long", TotalReturns="long",
    AverageMonthlyUSD="decimal(24,4)", ReturnRate="decimal(10,2)",
    MonthsOfOperation="decimal(5,1)",
)

# --- side inputs ----------------------------------------------------------

TRANSLATIONS = _layout(
    "original_name translated_name",
    original_name="string", translated_name="string",
)

RATES_FEED = _layout(
    "RateDate TargetCurrency Rate",
    RateDate="date", TargetCurrency="string", Rate="decimal(18,8)",
)

BRONZE = {
    "stores": STORES, "employees": EMPLOYEES, "products": PRODUCTS,
    "discounts": DISCOUNTS, "customers": CUSTOMERS,
    "transactions": TRANSACTIONS,
}

SILVER = {**BRONZE, "discounts": SILVER_DISCOUNTS}

GOLD = {
    "exchange_rates": EXCHANGE_RATES, "invoice_fact": INVOICE_FACT,
    "invoice_line_items": INVOICE_LINE_ITEMS, "customers": GOLD_CUSTOMERS,
    "stores": GOLD_STORES, "discounts": SILVER_DISCOUNTS,
    "products": PRODUCTS, "employees": EMPLOYEES,
}
