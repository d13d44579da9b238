"""Retail-shaped bronze tables out of the star-schema test tables.

Every column is a plain function of its source row, so the same tables can be
written down in another SQL engine. Awkward values (missing entries, foreign
spellings, broken phones, unknown stores and products, months without rates)
are placed by the remainder of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hemline import schemas
from hemline.sources.tables import spread


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _sql(df: DataFrame, schema, **columns: str) -> DataFrame:
    """One SQL expression per column, cast to the column's declared type."""
    return df.selectExpr(
        *[
            f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in schema.fields
        ]
    )


_STORE_CITY = """CASE n_nationkey % 9 WHEN 0 THEN '上海' WHEN 1 THEN 'München'
    WHEN 2 THEN 'Frankfurt am Main' WHEN 3 THEN '苏州' WHEN 4 THEN '苏州（江苏省）'
    WHEN 5 THEN 'Lisboa' WHEN 6 THEN '西安' ELSE n_name END"""

_COUNTRY = """CASE {k} % 9 WHEN 0 THEN '中国' WHEN 1 THEN 'España'
    WHEN 2 THEN 'Deutschland' WHEN 3 THEN 'United States' WHEN 4 THEN 'United Kingdom'
    WHEN 5 THEN 'France' WHEN 6 THEN 'Portugal' WHEN 7 THEN 'Italy' ELSE 'china' END"""


def stores(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = _table(spark, folder, "nation"), _table(spark, folder, "region")
    df = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    return _sql(
        df, schemas.STORES,
        StoreID="n_nationkey",
        Country=_COUNTRY.format(k="n_nationkey"),
        City=_STORE_CITY,
        StoreName=f"' Store ' || {_STORE_CITY} || '店 ' || r_name",
        NumberOfEmployees="CASE WHEN n_nationkey % 6 <> 0 THEN 4 END",
        ZIPCode="CAST(10000 + n_nationkey * 37 AS STRING)",
        Latitude="CAST(n_nationkey AS DECIMAL(10,6)) * 1.25BD - 15",
        Longitude="CAST(n_nationkey AS DECIMAL(10,6)) * 2.5BD - 30",
    )


def employees(spark: SparkSession, folder: str) -> DataFrame:
    return _sql(
        _table(spark, folder, "supplier"), schemas.EMPLOYEES,
        EmployeeID="s_suppkey",
        StoreID="s_nationkey",
        Name="""CASE WHEN s_suppkey % 4 = 0 THEN '王伟' WHEN s_suppkey % 4 = 1
            THEN 'Dr. Max ' || s_name WHEN s_suppkey % 4 = 2 THEN '李' || s_suppkey
            ELSE s_name || ' MBA.' END""",
        Position="""CASE s_suppkey % 3 WHEN 0 THEN 'STORE MANAGER'
            WHEN 1 THEN '  sales associate ' END""",
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _sql(
        _table(spark, folder, "part"), schemas.PRODUCTS,
        ProductID="p_partkey",
        Category="CASE WHEN p_type = 'PROMO' THEN 'CHILDREN' ELSE p_type END",
        SubCategory="""CASE WHEN p_brand = 'Brand#7'
            THEN 'Girl and Boy (1-5 years, 6-14 years)' ELSE ' ' || p_brand END""",
        DescriptionPT="'PT ' || p_name", DescriptionDE="'DE ' || p_name",
        DescriptionFR="'FR ' || p_name", DescriptionES="'ES ' || p_name",
        DescriptionEN="p_name", DescriptionZH="'中 ' || p_name",
        Color="CASE WHEN p_partkey % 7 <> 0 THEN upper(substring_index(p_name, ' ', 1)) END",
        Sizes="CASE WHEN p_size % 5 <> 0 THEN 'S|M|' || p_size END",
        ProductionCost="CAST(p_retailprice AS DECIMAL(10,2)) * 0.0025BD",
    )


def discounts(spark: SparkSession, folder: str) -> DataFrame:
    """Promotions per product group (three each), and yearly store-wide ones.

    Group promotions overlap; store-wide ones have no category and the two
    highest values, 0.09 and 0.10.
    """
    part = _table(spark, folder, "part")
    groups = (
        part.select(
            F.expr("CASE WHEN p_type = 'PROMO' THEN 'CHILDREN' ELSE p_type END").alias("cat"),
            F.expr("CAST(replace(p_brand, 'Brand#', '') AS INT)").alias("b"),
        )
        .distinct()
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2))))
        .withColumn("first", F.expr("date_add(DATE'1995-01-01', (b * 83 + k * 500) % 2200)"))
    )
    by_group = _sql(
        groups, schemas.DISCOUNTS,
        StartDate="first",
        EndDate="date_add(first, 300 + 100 * k)",
        Discount="CAST((b + 3 * k) % 8 + 1 AS DECIMAL(10,2)) * 0.01BD",
        Description="'Promotion ' || cat || ' ' || k",
        Category="cat",
        SubCategory="""CASE WHEN b = 7 THEN 'Girl and Boy (1-5 years, 6-14 years)'
            WHEN b % 5 = 0 THEN 'all' ELSE 'Brand#' || b END""",
    )
    years = (
        _table(spark, folder, "orders")
        .select(F.expr("CAST(year(o_orderdate) AS INT)").alias("y"))
        .distinct()
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(1))))
    )
    store_wide = _sql(
        years, schemas.DISCOUNTS,
        StartDate="make_date(y, 11 + k, 10)",
        EndDate="make_date(y, 11 + k, 30)",
        Discount="CAST(9 + k AS DECIMAL(10,2)) * 0.01BD",
        Description="'Store-wide ' || y",
        Category="CAST(NULL AS STRING)",
        SubCategory="CAST(NULL AS STRING)",
    )
    return by_group.unionByName(store_wide)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    df = _table(spark, folder, "customer").withColumn("k", F.expr("CAST(c_custkey AS INT)"))
    return _sql(
        df, schemas.CUSTOMERS,
        CustomerID="k",
        Name="""CASE WHEN k % 9 = 0 AND k % 2 = 0 THEN '李雷' WHEN k % 9 = 0 THEN '王小' || k
            WHEN k % 9 = 1 THEN 'Dr. Ann ' || c_name WHEN k % 9 = 2 THEN c_name || ' MD'
            WHEN k % 9 = 3 THEN 'Mdina ' || c_name WHEN k % 9 = 4 THEN '  Mrs. Dr. LEE dvm'
            ELSE c_name END""",
        Email="""CASE WHEN k % 50 = 0 THEN NULL WHEN k % 51 = 0 THEN 'user' || k || '.example'
            ELSE 'user' || k || '@example.com' END""",
        Telephone="""CASE k % 11 WHEN 0 THEN '(555) 123-4567x' || k
            WHEN 1 THEN '001-555-' || (1000000 + k) || 'x12' WHEN 2 THEN '+44 20 ' || k
            WHEN 3 THEN '01632 ' || k WHEN 4 THEN '(04930) ' || k WHEN 5 THEN '0033 1 ' || k
            WHEN 6 THEN k || ' 555' WHEN 7 THEN '0800.' || k WHEN 8 THEN NULL WHEN 9 THEN ''
            ELSE '[1] {' || k || '}/ext' END""",
        City="""CASE k % 8 WHEN 0 THEN '北京' WHEN 1 THEN 'Köln' WHEN 2 THEN 'guimarães'
            WHEN 3 THEN '石家庄' WHEN 4 THEN NULL ELSE 'TOWN ' || (k % 100) END""",
        Country=_COUNTRY.format(k="k"),
        Gender="CASE k % 3 WHEN 0 THEN ' f' WHEN 1 THEN 'M ' ELSE 'd' END",
        DateOfBirth="""CASE WHEN k % 41 = 0 THEN NULL WHEN k % 43 = 0 THEN DATE'1870-01-01'
            ELSE date_add(DATE'1930-01-01', CAST(c_custkey * 37 % 27000 AS INT)) END""",
        JobTitle="CASE WHEN k % 4 <> 0 THEN c_mktsegment || ' clerk' END",
    )


def translations(spark: SparkSession, folder: str) -> DataFrame:
    """English for most of the Chinese names of customers and employees."""
    names = (
        customers(spark, folder).select("Name")
        .unionByName(employees(spark, folder).select("Name"))
        .filter(F.col("Name").rlike("^(李雷|王伟|王小|李)"))
        .distinct()
        .withColumn("n", F.expr("try_cast(regexp_replace(Name, '[^0-9]', '') AS BIGINT)"))
        .filter("n IS NULL OR n % 5 <> 0")
    )
    return _sql(
        names, schemas.TRANSLATIONS,
        original_name="Name",
        translated_name="""CASE WHEN Name = '李雷' THEN 'li lei' WHEN Name = '王伟' THEN 'Wang WEI'
            WHEN Name LIKE '王小%' THEN 'Wang Xiao ' || n ELSE 'Li ' || n END""",
    )


# Line is not 1..n: it mixes the line's own columns into a number that is unique
# within the invoice, because (l_orderkey, l_linenumber) alone is not and
# numbering the lines would gather every large order in one task.
_LINE = """(l_partkey * 7919 + l_suppkey * 104729 + CAST(l_quantity AS BIGINT) * 31
    + CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * 100 AS BIGINT)) % 250000000 * 8
    + l_linenumber"""


def _signed(amount: str) -> str:
    return f"CASE WHEN o_orderkey % 10 = 0 THEN -({amount}) ELSE {amount} END"


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all orders; every line of each 37th order comes twice."""
    lines = spread(_table(spark, folder, "lineitem"), "l_orderkey")
    orders = _table(spark, folder, "orders")
    df = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    twice = F.when(F.col("o_orderkey") % 37 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    df = df.withColumn("_copy", F.explode(twice))
    price = "CAST(l_extendedprice AS DECIMAL(10,2))"
    return _sql(
        df, schemas.TRANSACTIONS,
        InvoiceID="'INV-' || o_orderkey",
        Line=_LINE,
        CustomerID="o_custkey",
        ProductID="CASE WHEN l_partkey % 997 = 5 THEN -1 ELSE l_partkey END",
        Size="""CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_partkey % 500 = 3 THEN 'NaN'
            ELSE 'M' END""",
        Color="CASE WHEN l_linenumber % 4 <> 0 THEN 'DARK ' || l_linestatus END",
        UnitPrice=price,
        Quantity="l_quantity",
        Timestamp="CAST(o_orderdate AS TIMESTAMP) + make_dt_interval(0, 0, 0, o_orderkey % 86400)",
        Discount="l_discount",
        LineTotal=_signed(f"{price} * (1 - CAST(l_discount AS DECIMAL(3,2)))"),
        StoreID="CASE WHEN o_orderkey % 26 = 24 THEN 25 ELSE o_orderkey % 26 END",
        EmployeeID="o_orderkey % 100",
        Currency="""CASE WHEN o_orderkey % 50 = 7 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'USD'
            WHEN o_orderkey % 4 = 1 THEN 'EUR' WHEN o_orderkey % 4 = 2 THEN 'GBP'
            ELSE 'CNY' END""",
        CurrencySymbol="CASE WHEN o_orderkey % 4 = 0 THEN '$' ELSE '¤' END",
        SKU="'SKU-' || l_partkey || '-' || l_linenumber",
        TransactionType="CASE WHEN o_orderkey % 10 = 0 THEN 'RETURN' ELSE ' sale ' END",
        PaymentMethod="""CASE o_orderkey % 3 WHEN 0 THEN 'credit card' WHEN 1 THEN ' CASH'
            ELSE 'pix' END""",
        InvoiceTotal=_signed("CAST(o_totalprice AS DECIMAL(10,2))"),
    )


def month_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").select(
        F.min("o_orderdate").cast("date").alias("first_day"),
        F.max("o_orderdate").cast("date").alias("last_day"),
    )


def rates_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly rates per dollar that move with the number of orders.

    July has no pound rate and nothing is quoted from June 2001 on.
    """
    months = (
        _table(spark, folder, "orders")
        .groupBy(F.trunc("o_orderdate", "month").alias("RateDate"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("RateDate < DATE'2001-06-01'")
        .withColumn("TargetCurrency", F.explode(F.array(*map(F.lit, ("EUR", "GBP", "CNY")))))
        .filter("NOT (TargetCurrency = 'GBP' AND month(RateDate) = 7)")
    )
    return _sql(
        months, schemas.RATES_FEED,
        RateDate="RateDate",
        TargetCurrency="TargetCurrency",
        Rate="""CAST(CASE TargetCurrency WHEN 'EUR' THEN 80 + n % 30 WHEN 'GBP' THEN 60 + n % 25
            ELSE 650 + n % 50 END AS DECIMAL(10,2)) * 0.01BD""",
    )


