"""One SQL statement per registered query, over the driver's tables.

Nothing here is shared with the Spark side but the fixed values in ``lookups``.
Money is exact: quotients are rounded as integers, half away from zero, because
DuckDB divides decimals as doubles.
"""

from __future__ import annotations

import re

from hemline.functions.lookups import CITY_NAMES, COUNTRY_NAMES


# --- snippets -------------------------------------------------------------

def std(x: str) -> str:
    """Trimmed, lower case, every blank-separated word with a capital."""
    return (f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
            "lambda w: upper(w[1]) || w[2:]), ' ')")


def rdiv(num: str, den: str) -> str:
    """Integer quotient rounded half away from zero; NULL for a zero divisor."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST(NULLIF({den}, 0) AS HUGEINT)"
    return f"(sign({n}) * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))) * sign({d}))"


def ratio(num: str, den: str, digits: int) -> str:
    """num / den of values with at most four decimals, rounded, as a double."""
    return f"CAST({rdiv(f'({num}) * 10000 * {10 ** digits}', f'({den}) * 10000')} AS DOUBLE) / {10 ** digits}"


def mean(x: str, digits: int = 2) -> str:
    return ratio(f"sum({x})", f"count({x})", digits)


def money(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def mapped(x: str, names: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in names.items())
    return f"CASE {x} {whens} ELSE {x} END"


def replaced(x: str, names: dict[str, str]) -> str:
    for k, v in names.items():
        x = f"replace({x}, {quoted(k)}, {quoted(v)})"
    return x


TITLES = (r"(?i)\b(B\.Sc\.|B\.A\.|Univ\.Prof\.|B\.Eng\.|MBA\.|Dipl\.-Ing\.|Ing\.|Prof\.|MD|DDS"
          r"|Dr\.|Mrs\.|DVM)\s*")


def no_titles(x: str) -> str:
    return f"trim(regexp_replace({x}, '{TITLES}', '', 'g'))"


def bare_phone(x: str) -> str:
    for noise in (r"[()\[\]{}]", r"x\d*", r"[.\-]", r"\s+"):
        x = f"regexp_replace({x}, '{noise}', '', 'g')"
    return f"trim({x})"


def dialled(p: str, c: str) -> str:
    return f"""CASE WHEN {p} LIKE '+%' THEN {p}
        WHEN regexp_matches({p}, '^0(1|33|34|44|49|86|351)') THEN '+' || substr({p}, 2)
        ELSE CASE {c} WHEN 'United Kingdom' THEN '+44' WHEN 'China' THEN '+86'
            WHEN 'France' THEN '+33' WHEN 'Germany' THEN '+49' WHEN 'Spain' THEN '+34'
            WHEN 'United States' THEN '+1' WHEN 'Portugal' THEN '+351' ELSE '' END
            || regexp_replace({p}, '^(1|01|001|0{{1,2}})', '') END"""


def shape(p: str) -> str:
    return (f"CASE WHEN length({p}) > 0 THEN regexp_replace(regexp_replace({p}, '\\p{{L}}', 'L', 'g'),"
            f" '\\p{{Nd}}', 'N', 'g') ELSE 'NULL' END")


RANGE_OLD, RANGE_NEW = "Girl and Boy (1-5 years, 6-14 years)", "Children(1-14 years)"


def child_range(x: str) -> str:
    return f"CASE WHEN {x} = '{RANGE_OLD}' THEN '{RANGE_NEW}' ELSE {x} END"


COUNTRY = """CASE {k} % 9 WHEN 0 THEN '中国' WHEN 1 THEN 'España' WHEN 2 THEN 'Deutschland'
    WHEN 3 THEN 'United States' WHEN 4 THEN 'United Kingdom' WHEN 5 THEN 'France'
    WHEN 6 THEN 'Portugal' WHEN 7 THEN 'Italy' ELSE 'china' END"""
STORE_CITY = """CASE n_nationkey % 9 WHEN 0 THEN '上海' WHEN 1 THEN 'München'
    WHEN 2 THEN 'Frankfurt am Main' WHEN 3 THEN '苏州' WHEN 4 THEN '苏州（江苏省）'
    WHEN 5 THEN 'Lisboa' WHEN 6 THEN '西安' ELSE n_name END"""


def signed(x: str) -> str:
    return f"CASE WHEN o_orderkey % 10 = 0 THEN -({x}) ELSE {x} END"


# --- common table expressions ---------------------------------------------

CTES: dict[str, str] = {}

CTES["b_stores"] = f"""
    SELECT n_nationkey AS StoreID, {COUNTRY.format(k='n_nationkey')} AS Country,
        {STORE_CITY} AS City, ' Store ' || {STORE_CITY} || '店 ' || r_name AS StoreName,
        CASE WHEN n_nationkey % 6 <> 0 THEN 4 END AS NumberOfEmployees,
        CAST(10000 + n_nationkey * 37 AS VARCHAR) AS ZIPCode,
        CAST(CAST(n_nationkey AS DECIMAL(10,6)) * 1.25 - 15 AS DECIMAL(10,6)) AS Latitude,
        CAST(CAST(n_nationkey AS DECIMAL(10,6)) * 2.5 - 30 AS DECIMAL(10,6)) AS Longitude
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

CTES["b_employees"] = """
    SELECT CAST(s_suppkey AS INT) AS EmployeeID, s_nationkey AS StoreID,
        CASE WHEN s_suppkey % 4 = 0 THEN '王伟' WHEN s_suppkey % 4 = 1 THEN 'Dr. Max ' || s_name
            WHEN s_suppkey % 4 = 2 THEN '李' || s_suppkey ELSE s_name || ' MBA.' END AS Name,
        CASE s_suppkey % 3 WHEN 0 THEN 'STORE MANAGER' WHEN 1 THEN '  sales associate ' END AS Position
    FROM supplier"""

CTES["b_products"] = f"""
    SELECT CAST(p_partkey AS INT) AS ProductID,
        CASE WHEN p_type = 'PROMO' THEN 'CHILDREN' ELSE p_type END AS Category,
        CASE WHEN p_brand = 'Brand#7' THEN '{RANGE_OLD}' ELSE ' ' || p_brand END AS SubCategory,
        'PT ' || p_name AS DescriptionPT, 'DE ' || p_name AS DescriptionDE,
        'FR ' || p_name AS DescriptionFR, 'ES ' || p_name AS DescriptionES,
        p_name AS DescriptionEN, '中 ' || p_name AS DescriptionZH,
        CASE WHEN p_partkey % 7 <> 0 THEN upper(split_part(p_name, ' ', 1)) END AS Color,
        CASE WHEN p_size % 5 <> 0 THEN 'S|M|' || p_size END AS Sizes,
        CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.0025 AS DECIMAL(10,4)) AS ProductionCost
    FROM part"""

CTES["b_discounts"] = f"""
    SELECT first AS StartDate, first + CAST(300 + 100 * k AS INT) AS EndDate,
        CAST(CAST((b + 3 * k) % 8 + 1 AS DECIMAL(10,2)) * 0.01 AS DECIMAL(10,2)) AS Discount,
        'Promotion ' || cat || ' ' || k AS Description, cat AS Category,
        CASE WHEN b = 7 THEN '{RANGE_OLD}' WHEN b % 5 = 0 THEN 'all'
            ELSE 'Brand#' || b END AS SubCategory
    FROM (SELECT cat, b, k, DATE '1995-01-01' + CAST((b * 83 + k * 500) % 2200 AS INT) AS first
          FROM (SELECT DISTINCT CASE WHEN p_type = 'PROMO' THEN 'CHILDREN' ELSE p_type END AS cat,
                    CAST(replace(p_brand, 'Brand#', '') AS INT) AS b FROM part),
               (SELECT unnest([0, 1, 2]) AS k))
    UNION ALL
    SELECT make_date(y, 11 + k, 10), make_date(y, 11 + k, 30),
        CAST(CAST(9 + k AS DECIMAL(10,2)) * 0.01 AS DECIMAL(10,2)), 'Store-wide ' || y, NULL, NULL
    FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders), (SELECT unnest([0, 1]) AS k)"""

CTES["b_customers"] = f"""
    SELECT k AS CustomerID,
        CASE WHEN k % 9 = 0 AND k % 2 = 0 THEN '李雷' WHEN k % 9 = 0 THEN '王小' || k
            WHEN k % 9 = 1 THEN 'Dr. Ann ' || c_name WHEN k % 9 = 2 THEN c_name || ' MD'
            WHEN k % 9 = 3 THEN 'Mdina ' || c_name WHEN k % 9 = 4 THEN '  Mrs. Dr. LEE dvm'
            ELSE c_name END AS Name,
        CASE WHEN k % 50 = 0 THEN NULL WHEN k % 51 = 0 THEN 'user' || k || '.example'
            ELSE 'user' || k || '@example.com' END AS Email,
        CASE k % 11 WHEN 0 THEN '(555) 123-4567x' || k
            WHEN 1 THEN '001-555-' || (1000000 + k) || 'x12' WHEN 2 THEN '+44 20 ' || k
            WHEN 3 THEN '01632 ' || k WHEN 4 THEN '(04930) ' || k WHEN 5 THEN '0033 1 ' || k
            WHEN 6 THEN k || ' 555' WHEN 7 THEN '0800.' || k WHEN 8 THEN NULL WHEN 9 THEN ''
            ELSE '[1] {{' || k || '}}/ext' END AS Telephone,
        CASE k % 8 WHEN 0 THEN '北京' WHEN 1 THEN 'Köln' WHEN 2 THEN 'guimarães' WHEN 3 THEN '石家庄'
            WHEN 4 THEN NULL ELSE 'TOWN ' || (k % 100) END AS City,
        {COUNTRY.format(k='k')} AS Country,
        CASE k % 3 WHEN 0 THEN ' f' WHEN 1 THEN 'M ' ELSE 'd' END AS Gender,
        CASE WHEN k % 41 = 0 THEN NULL WHEN k % 43 = 0 THEN DATE '1870-01-01'
            ELSE DATE '1930-01-01' + CAST(c_custkey * 37 % 27000 AS INT) END AS DateOfBirth,
        CASE WHEN k % 4 <> 0 THEN c_mktsegment || ' clerk' END AS JobTitle
    FROM (SELECT *, CAST(c_custkey AS INT) AS k FROM customer)"""

CTES["translations"] = """
    SELECT Name AS original_name,
        CASE WHEN Name = '李雷' THEN 'li lei' WHEN Name = '王伟' THEN 'Wang WEI'
            WHEN Name LIKE '王小%' THEN 'Wang Xiao ' || n ELSE 'Li ' || n END AS translated_name
    FROM (SELECT Name, TRY_CAST(regexp_replace(Name, '[^0-9]', '', 'g') AS BIGINT) AS n
          FROM (SELECT Name FROM b_customers UNION SELECT Name FROM b_employees)
          WHERE regexp_matches(Name, '^(李雷|王伟|王小|李)'))
    WHERE n IS NULL OR n % 5 <> 0"""

_PRICE = "CAST(l_extendedprice AS DECIMAL(10,2))"
CTES["b_transactions"] = f"""
    SELECT 'INV-' || o_orderkey AS InvoiceID,
        CAST((l_partkey * 7919 + l_suppkey * 104729 + CAST(l_quantity AS BIGINT) * 31
            + CAST({_PRICE} * 100 AS BIGINT)) % 250000000 * 8 + l_linenumber AS INT) AS Line,
        CAST(o_custkey AS INT) AS CustomerID,
        CAST(CASE WHEN l_partkey % 997 = 5 THEN -1 ELSE l_partkey END AS INT) AS ProductID,
        CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_partkey % 500 = 3 THEN 'NaN'
            ELSE 'M' END AS Size,
        CASE WHEN l_linenumber % 4 <> 0 THEN 'DARK ' || l_linestatus END AS Color,
        CAST({_PRICE} AS DECIMAL(10,4)) AS UnitPrice, CAST(l_quantity AS INT) AS Quantity,
        o_orderdate + to_seconds(o_orderkey % 86400) AS Timestamp,
        CAST(l_discount AS DECIMAL(10,2)) AS Discount,
        CAST({signed(f"{_PRICE} * (1 - CAST(l_discount AS DECIMAL(3,2)))")} AS DECIMAL(10,4)) AS LineTotal,
        CAST(CASE WHEN o_orderkey % 26 = 24 THEN 25 ELSE o_orderkey % 26 END AS INT) AS StoreID,
        CAST(o_orderkey % 100 AS INT) AS EmployeeID,
        CASE WHEN o_orderkey % 50 = 7 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'USD'
            WHEN o_orderkey % 4 = 1 THEN 'EUR' WHEN o_orderkey % 4 = 2 THEN 'GBP'
            ELSE 'CNY' END AS Currency,
        CASE WHEN o_orderkey % 4 = 0 THEN '$' ELSE '¤' END AS CurrencySymbol,
        'SKU-' || l_partkey || '-' || l_linenumber AS SKU,
        CASE WHEN o_orderkey % 10 = 0 THEN 'RETURN' ELSE ' sale ' END AS TransactionType,
        CASE o_orderkey % 3 WHEN 0 THEN 'credit card' WHEN 1 THEN ' CASH' ELSE 'pix' END AS PaymentMethod,
        CAST({signed("CAST(o_totalprice AS DECIMAL(10,2))")} AS DECIMAL(10,4)) AS InvoiceTotal
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    CROSS JOIN (SELECT unnest([1, 2]) AS copy) WHERE copy = 1 OR o_orderkey % 37 = 0"""

CTES["feed"] = """
    SELECT RateDate, c AS TargetCurrency,
        CAST(CASE c WHEN 'EUR' THEN 80 + n % 30 WHEN 'GBP' THEN 60 + n % 25
            ELSE 650 + n % 50 END AS BIGINT) AS cents
    FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS RateDate, count(*) AS n
          FROM orders GROUP BY 1), (SELECT unnest(['EUR', 'GBP', 'CNY']) AS c)
    WHERE RateDate < DATE '2001-06-01' AND NOT (c = 'GBP' AND month(RateDate) = 7)"""

CTES["rates"] = f"""
    SELECT RateDate, 'USD' AS BaseCurrency, TargetCurrency,
        CAST(CAST(cents AS DECIMAL(10,2)) * 0.01 AS DECIMAL(18,8)) AS ExchangeRate FROM feed
    UNION ALL
    SELECT RateDate, TargetCurrency, 'USD',
        CAST(CAST({rdiv('CAST(10000000000 AS HUGEINT)', 'cents')} AS DECIMAL(18,0)) * 0.00000001
            AS DECIMAL(18,8)) FROM feed"""

CTES["named"] = f"""
    SELECT * REPLACE ({no_titles('Name')} AS Name, {mapped('Country', COUNTRY_NAMES)} AS Country,
        {mapped('City', CITY_NAMES)} AS City) FROM b_customers"""

CTES["translated"] = """
    SELECT c.* REPLACE (coalesce(t.translated_name, c.Name) AS Name)
    FROM named c LEFT JOIN translations t ON c.Name = t.original_name AND c.Country = 'China'"""

CTES["phoned"] = f"SELECT * REPLACE ({bare_phone('Telephone')} AS Telephone) FROM translated"

CTES["s_customers"] = f"""
    SELECT * REPLACE ({std('Name')} AS Name, {dialled('Telephone', 'Country')} AS Telephone,
        {std('City')} AS City, {std('Country')} AS Country, {std('Gender')} AS Gender,
        {std("coalesce(JobTitle, 'Not Specified')")} AS JobTitle) FROM phoned"""

CTES["s_employees"] = f"""
    SELECT EmployeeID, StoreID, {std('coalesce(t.translated_name, e.Name)')} AS Name,
        {std('Position')} AS Position
    FROM (SELECT * REPLACE ({no_titles('Name')} AS Name) FROM b_employees) e
    LEFT JOIN translations t ON e.Name = t.original_name AND e.StoreID IN (6, 7, 8, 9, 10)"""

CTES["s_products"] = f"""
    SELECT * REPLACE ({std('Category')} AS Category, {std(child_range('SubCategory'))} AS SubCategory,
        {std("coalesce(Color, 'Not Specified')")} AS Color, coalesce(Sizes, 'One Size') AS Sizes)
    FROM b_products"""

CTES["s_discounts"] = f"""
    SELECT StartDate, EndDate, CAST(row_number() OVER (ORDER BY Discount NULLS FIRST,
            StartDate NULLS FIRST, EndDate NULLS FIRST, c, s, Description NULLS FIRST) AS INT) AS DiscountID,
        Discount, Description, {std('c')} AS Category, {std('s')} AS SubCategory
    FROM (SELECT *, coalesce(Category, 'All') AS c,
              {child_range("coalesce(SubCategory, 'All')")} AS s FROM b_discounts)"""

CTES["places"] = f"""
    SELECT * REPLACE ({std(mapped('Country', COUNTRY_NAMES))} AS Country,
        {std(mapped('City', CITY_NAMES))} AS City,
        {std(replaced('StoreName', CITY_NAMES))} AS StoreName) FROM b_stores"""

CTES["staffed"] = """
    SELECT p.*, coalesce(n, 0) AS actual FROM places p
    LEFT JOIN (SELECT StoreID, count(EmployeeID) AS n FROM s_employees GROUP BY StoreID) e
        ON p.StoreID = e.StoreID"""

CTES["s_stores"] = """
    SELECT * EXCLUDE (actual) REPLACE (CAST(CASE WHEN NumberOfEmployees <> actual THEN actual
        ELSE NumberOfEmployees END AS INT) AS NumberOfEmployees) FROM staffed"""

CTES["s_transactions"] = f"""
    SELECT * REPLACE ({std("coalesce(Color, 'Not Specified')")} AS Color,
        coalesce(Size, 'One Size') AS Size, {std('TransactionType')} AS TransactionType,
        {std('PaymentMethod')} AS PaymentMethod) FROM (SELECT DISTINCT * FROM b_transactions)"""

_MONTH = "CAST(date_trunc('month', {d}) AS DATE)"

CTES["invoices"] = f"""
    WITH i AS (
        SELECT InvoiceID, CustomerID, CAST(Timestamp AS DATE) AS Date,
            strftime(Timestamp, '%H:%M:%S') AS Time, StoreID, EmployeeID, Currency, CurrencySymbol,
            TransactionType, PaymentMethod, InvoiceTotal, CAST(sum(Quantity) AS INT) AS TotalQuantity
        FROM s_transactions GROUP BY ALL)
    SELECT i.InvoiceID, CustomerID, Date, Time, i.StoreID, p.Country AS StoreCountry,
        p.City AS StoreCity, EmployeeID, TotalQuantity, Currency, CurrencySymbol, TransactionType,
        PaymentMethod, InvoiceTotal,
        CAST(CASE WHEN Currency = 'USD' THEN InvoiceTotal
            ELSE InvoiceTotal * coalesce(ExchangeRate, CAST(1 AS DECIMAL(18,8))) END
            AS DECIMAL(10,4)) AS InvoiceTotalUSD
    FROM i LEFT JOIN places p ON i.StoreID = p.StoreID
    LEFT JOIN rates r ON {_MONTH.format(d='Date')} = RateDate AND Currency = BaseCurrency
        AND TargetCurrency = 'USD'"""

CTES["dims"] = """
    SELECT t.*, CAST(Timestamp AS DATE) AS Date, p.Category, p.SubCategory, p.ProductionCost,
        s.Country, s.City
    FROM s_transactions t LEFT JOIN s_products p ON t.ProductID = p.ProductID
    LEFT JOIN places s ON t.StoreID = s.StoreID"""

CTES["usd"] = f"""
    SELECT d.*, CAST(CASE WHEN Currency = 'USD' THEN LineTotal
            ELSE LineTotal * coalesce(ExchangeRate, CAST(1 AS DECIMAL(18,8))) END
            AS DECIMAL(10,4)) AS LineTotalUSD
    FROM dims d LEFT JOIN rates ON {_MONTH.format(d='Date')} = RateDate AND Currency = BaseCurrency
        AND TargetCurrency = 'USD'"""

# matched first, then joined back on the line key: two steps, unlike the Spark side
CTES["matches"] = """
    SELECT t.InvoiceID, t.Line, d.DiscountID
    FROM dims t LEFT JOIN s_discounts d ON t.Discount = d.Discount
        AND t.Date >= d.StartDate AND t.Date <= d.EndDate
        AND (d.Category = t.Category OR d.Category = 'All')
        AND (d.SubCategory = t.SubCategory OR d.SubCategory = 'All')
    WHERE t.TransactionType = 'Sale' AND t.Discount > 0"""

CTES["attached"] = """
    SELECT u.*, m.DiscountID FROM usd u
    LEFT JOIN matches m ON u.InvoiceID = m.InvoiceID AND u.Line = m.Line"""

_MARGIN = "LineTotalUSD - ProductionCost * Quantity"


def margins(source: str) -> str:
    share = rdiv(f"({_MARGIN}) * 10000 * 10000", "LineTotalUSD * 10000")
    return f"""
    SELECT *, CAST(ProductionCost * Quantity AS DECIMAL(10,4)) AS TotalProductionCost,
        CASE WHEN TransactionType = 'Sale' THEN CAST({_MARGIN} AS DECIMAL(10,4)) END AS ContributionMargin,
        CASE WHEN TransactionType = 'Sale' AND LineTotalUSD > 0
            THEN CAST(CAST({share} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) END AS ContributionMarginPercentage
    FROM {source}"""


CTES["margin_only"] = margins("usd")
CTES["items"] = margins("attached")

CTES["numbered"] = """
    SELECT *, row_number() OVER (ORDER BY InvoiceID, Line, DiscountID NULLS FIRST) AS LineItemID
    FROM items"""

CTES["as_of"] = "SELECT CAST(date_trunc('month', max(Date)) AS DATE) + INTERVAL 1 MONTH AS d FROM items"

CTES["spending"] = f"""
    SELECT CustomerID, sum(LineTotalUSD) AS TotalSpending, count(DISTINCT InvoiceID) AS NoOfInvoices,
        {ratio('sum(LineTotalUSD)', 'count(DISTINCT InvoiceID)', 4)} AS AverageSpending,
        max(Date) AS LastPurchaseDate
    FROM items WHERE TransactionType = 'Sale' GROUP BY CustomerID"""

CTES["parents"] = """
    SELECT CustomerID, count(*) AS children_product_purchases FROM items
    WHERE Category = 'Children' AND TransactionType = 'Sale'
    GROUP BY CustomerID HAVING count(*) >= 2"""

CTES["enriched"] = """
    SELECT c.*, p.CustomerID IS NOT NULL AS IsParent,
        coalesce(s.TotalSpending, 0) AS TotalSpending, coalesce(s.NoOfInvoices, 0) AS NoOfInvoices,
        coalesce(s.AverageSpending, 0) AS AverageSpending, s.LastPurchaseDate
    FROM s_customers c LEFT JOIN parents p ON c.CustomerID = p.CustomerID
    LEFT JOIN spending s ON c.CustomerID = s.CustomerID"""

CTES["rfm"] = """
    SELECT CustomerID,
        CAST(date_diff('day', coalesce(LastPurchaseDate, d), CAST(d AS DATE)) AS INT) AS Recency,
        NoOfInvoices AS Frequency, TotalSpending AS Monetary
    FROM enriched, (SELECT CAST(d AS DATE) AS d FROM as_of)"""

CTES["scores"] = """
    SELECT *, CAST(R_Score AS VARCHAR) || F_Score || M_Score AS RFM_Score FROM (
        SELECT *, ntile(5) OVER (ORDER BY Recency DESC, CustomerID) AS R_Score,
            ntile(5) OVER (ORDER BY Frequency, CustomerID) AS F_Score,
            ntile(5) OVER (ORDER BY Monetary, CustomerID) AS M_Score FROM rfm)"""

CTES["segments"] = """
    SELECT *, CASE
        WHEN R_Score >= 4 AND F_Score >= 4 AND M_Score >= 4 THEN 'Champions'
        WHEN R_Score >= 3 AND F_Score >= 3 AND M_Score >= 3 THEN 'Loyal'
        WHEN R_Score >= 4 AND F_Score >= 3 AND M_Score < 3 THEN 'Potential Loyalists'
        WHEN R_Score >= 3 AND F_Score < 3 AND M_Score >= 3 THEN 'Big Spenders'
        WHEN R_Score < 2 AND F_Score >= 4 AND M_Score >= 4 THEN 'At Risk'
        WHEN R_Score < 2 AND F_Score >= 3 AND M_Score < 3 THEN 'Need Attention'
        WHEN R_Score < 2 AND F_Score < 3 AND M_Score < 3 THEN 'About to Leave'
        WHEN R_Score >= 4 AND F_Score < 2 AND M_Score < 2 THEN 'New'
        WHEN R_Score < 3 AND F_Score < 3 AND M_Score >= 3 THEN 'High Value Prospects'
        ELSE 'Others' END AS RFM_Segment FROM scores"""

CTES["aged"] = """
    SELECT *, CASE WHEN Age IS NULL THEN 'Unknown' WHEN Age < 18 THEN 'Under 18'
            WHEN Age < 25 THEN '18-24' WHEN Age < 35 THEN '25-34' WHEN Age < 45 THEN '35-44'
            WHEN Age < 55 THEN '45-54' WHEN Age < 65 THEN '55-64' ELSE '65+' END AS AgeGroup
    FROM (SELECT *, CASE WHEN years BETWEEN 0 AND 120 THEN years END AS Age
          FROM (SELECT *, CAST(floor(date_diff('day', DateOfBirth, CAST(d AS DATE)) / 365.25) AS INT) AS years
                FROM s_customers, as_of))"""

CTES["g_customers"] = """
    SELECT e.CustomerID, e.Name, e.Email, e.Telephone, e.City, e.Country, e.Gender, e.DateOfBirth,
        e.JobTitle, a.Age, a.AgeGroup, e.IsParent, e.TotalSpending, e.NoOfInvoices,
        e.AverageSpending, g.RFM_Segment, g.Recency
    FROM enriched e JOIN aged a ON e.CustomerID = a.CustomerID
    LEFT JOIN segments g ON e.CustomerID = g.CustomerID"""

CTES["store_figures"] = """
    SELECT StoreID, sum(CASE WHEN TransactionType = 'Sale' THEN LineTotalUSD ELSE 0 END) AS TotalSalesUSD,
        count(DISTINCT CASE WHEN TransactionType = 'Sale' THEN InvoiceID END) AS TotalTransactions,
        count(DISTINCT CASE WHEN TransactionType = 'Return' THEN InvoiceID END) AS TotalReturns,
        sum(CASE WHEN TransactionType = 'Return' THEN abs(LineTotalUSD) ELSE 0 END) AS TotalReturnsUSD,
        min(Date) AS FirstTransactionDate, max(Date) AS LastTransactionDate,
        count(DISTINCT strftime(Date, '%Y-%m')) AS MonthsWithTransactions
    FROM items GROUP BY StoreID"""

# whole months when both days agree or both end their month, else thirty-firsts of the rest
_MONTHS = """(year(b) - year(a)) * 12 + month(b) - month(a) + CASE WHEN day(a) = day(b)
    OR (a = last_day(a) AND b = last_day(b)) THEN 0.0 ELSE (day(b) - day(a)) / 31.0 END"""

CTES["g_stores"] = f"""
    SELECT s.*, coalesce(TotalSalesUSD, 0) AS TotalSalesUSD,
        coalesce(TotalTransactions, 0) AS TotalTransactions, coalesce(TotalReturns, 0) AS TotalReturns,
        CASE WHEN coalesce(MonthsWithTransactions, 0) > 0
            THEN {ratio('TotalSalesUSD', 'MonthsWithTransactions', 4)} ELSE 0 END AS AverageMonthlyUSD,
        CASE WHEN coalesce(TotalTransactions, 0) > 0
            THEN {ratio('TotalReturnsUSD * 100', 'TotalSalesUSD', 2)} ELSE 0 END AS ReturnRate,
        round(CASE WHEN a IS NOT NULL THEN {_MONTHS} + 1 ELSE 0 END, 1) AS MonthsOfOperation
    FROM s_stores s LEFT JOIN (SELECT *, FirstTransactionDate AS a, LastTransactionDate AS b
                               FROM store_figures) m ON s.StoreID = m.StoreID"""


def with_tables(select: str) -> str:
    """Prefix the statement with the expressions it uses, in dependency order."""
    used: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b(?:FROM|JOIN|,)\s*\(?\s*(\w+)", text):
            if word in CTES and word not in used:
                visit(CTES[word])
                used.append(word)

    visit(select)
    if not used:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in used) + "\n" + select


def doubles(*names: str) -> str:
    return "* REPLACE (" + ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names) + ")"


_STAMP = "strftime(Timestamp, '%Y-%m-%d %H:%M:%S') AS Timestamp"
_LINE_MONEY = ("UnitPrice", "Discount", "LineTotal", "LineTotalUSD", "ProductionCost",
               "TotalProductionCost", "ContributionMargin", "ContributionMarginPercentage")
_STORE_MONEY = ("Latitude", "Longitude", "TotalSalesUSD", "AverageMonthlyUSD", "ReturnRate",
                "MonthsOfOperation")


def null_counts(source: str, columns: str, missing: str, rest: str = "") -> str:
    """UNION of one count per column."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {missing.format(c=c)}) AS null_count"
        f"{rest} FROM {source}"
        for c in columns.split()
    )


_CUSTOMER_COLUMNS = {
    "CustomerID": ("int", "true"), "Name": ("string", "true"), "Email": ("string", "true"),
    "Telephone": ("string", "true"), "City": ("string", "true"), "Country": ("string", "false"),
    "Gender": ("string", "false"), "DateOfBirth": ("date", "true"), "JobTitle": ("string", "true"),
}
_TRANSACTION_COLUMNS = (
    "InvoiceID Line CustomerID ProductID Size Color UnitPrice Quantity Timestamp Discount LineTotal "
    "StoreID EmployeeID Currency CurrencySymbol SKU TransactionType PaymentMethod InvoiceTotal")


def summary(source: str, *columns: str) -> str:
    """The statistics of a summary table, every quantile an actual value."""
    figures = {
        "count": "count({c})", "mean": "round(avg({c}), 2)", "stddev": "round(stddev_samp({c}), 2)",
        "min": "round(min({c}), 2)", "25%": "round(quantile_disc({c}, 0.25), 2)",
        "50%": "round(quantile_disc({c}, 0.5), 2)", "75%": "round(quantile_disc({c}, 0.75), 2)",
        "max": "round(max({c}), 2)",
    }
    rows = []
    for name, figure in figures.items():
        cells = ", ".join(
            f"CAST({figure.format(c=f'CAST({c} AS DOUBLE)')} AS DOUBLE) AS {c}" for c in columns)
        rows.append(f"SELECT '{name}' AS statistic, {cells} FROM {source}")
    return " UNION ALL ".join(rows)


def margin_report(percent: str, key: str = "", where: str = "") -> str:
    keys = f"{key}, " if key else ""
    group = "GROUP BY 1" if key else ""
    return f"""SELECT {keys}count(*) AS LineItemCount, {money('sum(LineTotalUSD)')} AS TotalRevenue,
        {money('sum(TotalProductionCost)')} AS TotalCost, {money('sum(ContributionMargin)')} AS TotalMargin,
        {ratio('sum(ContributionMargin) * 100', 'sum(LineTotalUSD)', 2)} AS {percent}
        FROM items WHERE TransactionType = 'Sale' AND LineTotalUSD > 0 {group}"""


_INVOICES = f"SELECT {doubles('InvoiceTotal', 'InvoiceTotalUSD')} FROM invoices"

_USAGE = """SELECT d.DiscountID, StartDate, EndDate, CAST(d.Discount AS DOUBLE) AS Discount, d.Category,
    d.SubCategory, count(t.InvoiceID) AS TransactionCount, CAST(sum(t.LineTotalUSD) AS DOUBLE) AS TotalSales
    FROM s_discounts d LEFT JOIN items t ON d.DiscountID = t.DiscountID
    GROUP BY d.DiscountID, StartDate, EndDate, d.Discount, d.Category, d.SubCategory"""

_TIDY_CUSTOMERS = "SELECT * REPLACE (nullif(Telephone, '') AS Telephone) FROM b_customers"

_FITTING_INVOICES = f"SELECT {doubles('InvoiceTotal', 'InvoiceTotalUSD')} FROM invoices " \
    "WHERE abs(InvoiceTotal) <= 214748.3647 AND abs(InvoiceTotalUSD) <= 214748.3647"

_PLAIN: dict[str, str] = {
    "csv_roundtrip": _TIDY_CUSTOMERS,
    "enforce_schema": f"SELECT {doubles('ProductionCost')} FROM b_products",
    "conforming_rows": "SELECT * FROM b_customers WHERE Name NOT LIKE 'Customer#%'",
    "rejected_rows": "SELECT CustomerID, 'Name' AS missing_columns FROM b_customers "
                     "WHERE Name LIKE 'Customer#%'",
    "describe_table": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS data_type, {nullable} AS nullable, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS row_count FROM b_customers"
        for c, (kind, nullable) in _CUSTOMER_COLUMNS.items()),
    "table_roundtrip": f"SELECT {doubles('ProductionCost')} FROM s_products",
    "verify_roundtrip": "SELECT count(*) AS written_count, count(*) AS read_count, "
                        "true AS counts_match, true AS types_match FROM s_customers",
    "promote_table": "SELECT * FROM s_employees",
    "export_mapping": _FITTING_INVOICES,
    "export_rejects": """SELECT 'invoice_fact' AS table_name, InvoiceID AS row_key, 'InvoiceTotal' AS column_name,
            CAST(InvoiceTotal AS VARCHAR) AS value FROM invoices WHERE abs(InvoiceTotal) > 214748.3647
        UNION ALL SELECT 'invoice_fact', InvoiceID, 'InvoiceTotalUSD', CAST(InvoiceTotalUSD AS VARCHAR)
        FROM invoices WHERE abs(InvoiceTotalUSD) > 214748.3647""",
    "malformed_conforming": "SELECT * FROM b_customers WHERE CustomerID % 29 <> 0 AND CustomerID % 31 <> 0",
    "malformed_rejected": """SELECT Email, '' AS missing_columns,
        concat_ws(',', CASE WHEN CustomerID % 31 = 0 THEN 'CustomerID' END,
                  CASE WHEN CustomerID % 29 = 0 THEN 'DateOfBirth' END) AS malformed_columns
        FROM b_customers WHERE CustomerID % 29 = 0 OR CustomerID % 31 = 0""",
    "sample_rows": "SELECT InvoiceID, Line, ProductID, CAST(LineTotal AS DOUBLE) AS LineTotal "
                   "FROM s_transactions ORDER BY InvoiceID, Line LIMIT 5",
    "null_profile": null_counts("b_customers", " ".join(_CUSTOMER_COLUMNS), "{c} IS NULL"),
    "null_nan_profile": " UNION ALL ".join(
        f"SELECT column_name, null_count, {ratio('null_count * 100', 'n', 2)} AS null_percentage FROM ("
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL OR CAST({c} AS VARCHAR) = 'NaN')"
        f" AS null_count, count(*) AS n FROM b_transactions)"
        for c in _TRANSACTION_COLUMNS.split()),
    "duplicate_rows": "SELECT 2 * count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM b_transactions)) "
                      "AS duplicate_rows FROM b_transactions",
    "duplicate_keys": "SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_keys "
                      "FROM lineitem",
    "dedup_transactions": "SELECT InvoiceID, Line, SKU, CAST(LineTotal AS DOUBLE) AS LineTotal "
                          "FROM (SELECT DISTINCT * FROM b_transactions)",
    "dedup_by_key": "SELECT InvoiceID, Line, SKU, CAST(LineTotal AS DOUBLE) AS LineTotal "
                    "FROM (SELECT DISTINCT * FROM b_transactions)",
    "key_violations": "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem "
                      "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "gold_key_violations": "SELECT InvoiceID, Line, DiscountID, count(*) AS copies FROM numbered "
                           "GROUP BY ALL HAVING count(*) > 1",
    "csv_rejects": """SELECT CustomerID || ',' || Email || CASE WHEN CustomerID % 37 = 0
            THEN ',' || Gender || ',' || DateOfBirth || ',more' ELSE '' END AS record,
            CASE WHEN CustomerID % 37 = 0 THEN 4 ELSE 2 END AS values_found
        FROM b_customers WHERE Email IS NOT NULL AND DateOfBirth IS NOT NULL
            AND (CustomerID % 37 = 0 OR CustomerID % 41 = 0)""",
    "check_emails": """SELECT count(*) AS total_count, count(*) FILTER (WHERE contains(Email, '@'))
        AS valid_count, count(*) = count(*) FILTER (WHERE contains(Email, '@')) AS all_valid
        FROM b_customers""",
    "check_phone_prefix": """SELECT count(*) AS total_count, count(*) FILTER (WHERE Telephone LIKE '+%')
        AS valid_count, count(*) = count(*) FILTER (WHERE Telephone LIKE '+%') AS all_valid
        FROM s_customers""",
    "country_distribution": "SELECT Country, count(*) AS \"count\" FROM b_stores GROUP BY Country",
    "phone_pattern_counts": f"SELECT {shape('Telephone')} AS PhonePattern, count(*) AS \"count\" "
                            "FROM b_customers GROUP BY 1",
    "phone_patterns": f"SELECT CustomerID, {shape('Telephone')} AS PhonePattern FROM b_customers",
    "phone_chars": """SELECT DISTINCT unnest(string_split(regexp_replace(Telephone, '[0-9]', '', 'g'), ''))
        AS character FROM b_customers WHERE regexp_matches(Telephone, '[^0-9]')""",
    "phone_extra_chars": """SELECT DISTINCT unnest(regexp_extract_all(Telephone, '[^+0-9]')) AS character
        FROM phoned""",
    "discount_date_range": "SELECT min(StartDate) AS min_date, max(StartDate) AS max_date FROM b_discounts",
    "discount_pattern_check": """SELECT (SELECT count(*) FROM b_discounts WHERE Category IS NULL
            OR SubCategory IS NULL) AS left_count,
        (SELECT count(*) FROM b_discounts WHERE Discount IN (0.09, 0.10)) AS right_count,
        (SELECT count(*) FROM (SELECT * FROM b_discounts WHERE Category IS NULL OR SubCategory IS NULL
            EXCEPT ALL SELECT * FROM b_discounts WHERE Discount IN (0.09, 0.10))) AS only_left,
        (SELECT count(*) FROM (SELECT * FROM b_discounts WHERE Discount IN (0.09, 0.10)
            EXCEPT ALL SELECT * FROM b_discounts WHERE Category IS NULL OR SubCategory IS NULL)) AS only_right,
        true AS same""",
    "null_size_subcategories": "SELECT DISTINCT SubCategory FROM b_products WHERE Sizes IS NULL",
    "distinct_jobtitles": "SELECT count(*) AS distinct_count FROM (SELECT DISTINCT JobTitle FROM s_customers)",
    "default_nulls": """SELECT InvoiceID, Line, coalesce(Color, 'Not Specified') AS Color,
        coalesce(Size, 'One Size') AS Size FROM b_transactions""",
    "replace_values": f"SELECT ProductID, {child_range('SubCategory')} AS SubCategory FROM b_products",
    "standardize_text": f"""SELECT ProductID, {std('Category')} AS Category,
        {std('SubCategory')} AS SubCategory, {std('Color')} AS Color FROM b_products""",
    "clean_names": f"SELECT CustomerID, {no_titles('Name')} AS Name FROM b_customers",
    "translate_geo": "SELECT CustomerID, Country, City FROM named",
    "translate_store_names": "SELECT StoreID, StoreName, City FROM places",
    "names_to_translate": """SELECT DISTINCT Name AS original_name FROM named
        WHERE Country = 'China' AND Name IS NOT NULL""",
    "translate_names": "SELECT CustomerID, Country, Name FROM translated",
    "untranslated_names": "SELECT CustomerID, Name FROM translated WHERE Country = 'China' "
                          "AND regexp_matches(Name, '[一-鿿]')",
    "clean_phones": "SELECT CustomerID, Telephone FROM phoned",
    "normalize_phones": f"SELECT CustomerID, Country, {dialled('Telephone', 'Country')} AS Telephone "
                        "FROM phoned",
    "filter_sales": "SELECT InvoiceID, Line, TransactionType, CAST(LineTotal AS DOUBLE) AS LineTotal "
                    "FROM s_transactions WHERE TransactionType = 'Sale'",
    "employee_discrepancies": """SELECT StoreID, StoreName, NumberOfEmployees,
        actual AS Actual_Employee_Count FROM staffed WHERE NumberOfEmployees <> actual""",
    "employee_reconcile": "SELECT StoreID, NumberOfEmployees FROM s_stores",
    "discount_ids": """SELECT DiscountID, CAST(Discount AS DOUBLE) AS Discount, StartDate, EndDate,
        Category, SubCategory FROM s_discounts""",
    "silver_customers": "SELECT * FROM s_customers",
    "silver_employees": "SELECT * FROM s_employees",
    "silver_products": f"SELECT {doubles('ProductionCost')} FROM s_products",
    "silver_discounts": f"SELECT {doubles('Discount')} FROM s_discounts",
    "silver_stores": f"SELECT {doubles('Latitude', 'Longitude')} FROM s_stores",
    "silver_transactions": "SELECT * REPLACE (" + _STAMP + ", " + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" for c in ("UnitPrice", "Discount", "LineTotal", "InvoiceTotal"))
        + ") FROM s_transactions",
    "exchange_rates": f"SELECT {doubles('ExchangeRate')} FROM rates",
    "rates_extended": f"SELECT {doubles('ExchangeRate')} FROM rates",
    "invoice_fact": _INVOICES,
    "invoice_fact_incremental": _INVOICES,
    "fx_invoice": """SELECT InvoiceID, Date, Currency, CAST(InvoiceTotal AS DOUBLE) AS InvoiceTotal,
        CAST(InvoiceTotalUSD AS DOUBLE) AS InvoiceTotalUSD FROM invoices""",
    "fx_missing": f"""SELECT {_MONTH.format(d='Date')} AS Month, Currency, count(*) AS row_count
        FROM dims WHERE (Currency IS NULL OR Currency <> 'USD') AND NOT EXISTS (SELECT 1 FROM rates
            WHERE RateDate = {_MONTH.format(d='Date')} AND BaseCurrency = Currency
            AND TargetCurrency = 'USD') GROUP BY 1, 2""",
    "sql_over_tables": """SELECT l.Country, s.NumberOfEmployees, count(*) AS LineCount
        FROM dims l LEFT JOIN s_stores s ON l.StoreID = s.StoreID
        WHERE l.TransactionType = 'Return' GROUP BY 1, 2""",
    "line_items_dims": "SELECT InvoiceID, Line, ProductID, Category, SubCategory, StoreID, Country, City "
                       "FROM dims",
    "fx_line": """SELECT InvoiceID, Line, Date, Currency, CAST(LineTotal AS DOUBLE) AS LineTotal,
        CAST(LineTotalUSD AS DOUBLE) AS LineTotalUSD FROM usd""",
    "discount_match": "SELECT InvoiceID, Line, DiscountID FROM matches",
    "discount_attach": """SELECT InvoiceID, Line, TransactionType, CAST(Discount AS DOUBLE) AS Discount,
        Date, Category, SubCategory, DiscountID FROM attached""",
    "discount_attach_first": "SELECT InvoiceID, Line, min(DiscountID) AS DiscountID FROM attached "
                             "GROUP BY InvoiceID, Line",
    "line_item_ids": "SELECT LineItemID, InvoiceID, Line, DiscountID FROM numbered",
    "margin_lines": f"SELECT {doubles('LineTotalUSD', *_LINE_MONEY[4:])} FROM (SELECT InvoiceID, Line, "
        "TransactionType, Quantity, LineTotalUSD, ProductionCost, TotalProductionCost, "
        "ContributionMargin, ContributionMarginPercentage FROM margin_only)",
    "invoice_line_items": f"""SELECT {doubles(*_LINE_MONEY)} FROM (SELECT LineItemID, InvoiceID, Line,
        CustomerID, ProductID, Category, SubCategory, StoreID, Country, City, Size, Color, UnitPrice,
        Quantity, Discount, DiscountID, SKU, Date, TransactionType, LineTotal, LineTotalUSD,
        ProductionCost, TotalProductionCost, ContributionMargin, ContributionMarginPercentage
        FROM numbered)""",
    "as_of_date": "SELECT CAST(d AS DATE) AS as_of FROM as_of",
    "age_groups": "SELECT CustomerID, DateOfBirth, Age, AgeGroup FROM aged",
    "parent_customers": "SELECT * FROM parents",
    "customer_spending": f"SELECT {doubles('TotalSpending')} FROM (SELECT * EXCLUDE (LastPurchaseDate) "
                         "FROM spending)",
    "customer_last_purchase": "SELECT CustomerID, LastPurchaseDate FROM spending",
    "customer_metrics": """SELECT a.CustomerID, CAST(s.TotalSpending AS DOUBLE) AS TotalSpending,
        coalesce(s.NoOfInvoices, 0) AS NoOfInvoices, s.LastPurchaseDate, a.LastActivityDate,
        a.ChildrenPurchases, s.AverageSpending
        FROM (SELECT CustomerID, max(Date) AS LastActivityDate, count(*) FILTER (WHERE
            Category = 'Children' AND TransactionType = 'Sale') AS ChildrenPurchases
            FROM items GROUP BY CustomerID) a LEFT JOIN spending s ON a.CustomerID = s.CustomerID""",
    "customer_spending_enriched": """SELECT CustomerID, IsParent, CAST(TotalSpending AS DOUBLE) AS
        TotalSpending, NoOfInvoices, AverageSpending FROM enriched""",
    "spending_summary": summary("enriched", "TotalSpending", "NoOfInvoices", "AverageSpending"),
    "customer_rfm": f"SELECT {doubles('Monetary')} FROM rfm",
    "rfm_scores": "SELECT CustomerID, R_Score, F_Score, M_Score, RFM_Score FROM scores",
    "rfm_table": f"SELECT {doubles('Monetary')} FROM (SELECT r.*, R_Score, F_Score, M_Score, RFM_Score, RFM_Segment "
                 "FROM rfm r JOIN segments s ON r.CustomerID = s.CustomerID)",
    "rfm_segments": "SELECT CustomerID, RFM_Score, RFM_Segment FROM segments",
    "gold_customers": f"SELECT {doubles('TotalSpending', 'AverageSpending')} FROM g_customers",
    "store_metrics": f"SELECT {doubles('TotalSalesUSD', 'TotalReturnsUSD')} FROM store_figures",
    "gold_stores": f"SELECT {doubles(*_STORE_MONEY)} FROM g_stores",
    "store_summary": summary("g_stores", "TotalSalesUSD", "AverageMonthlyUSD", "TotalTransactions",
                             "ReturnRate"),
    "discount_status": """SELECT TransactionType,
        CASE WHEN Discount > 0 THEN 'Discounted' ELSE 'Regular Price' END AS PriceType,
        CASE WHEN DiscountID IS NOT NULL THEN 'With DiscountID'
            WHEN Discount > 0 AND DiscountID IS NULL THEN 'Missing DiscountID'
            ELSE 'No DiscountID Required' END AS DiscountIDStatus, count(*) AS RecordCount
        FROM items GROUP BY 1, 2, 3""",
    "discount_usage": _USAGE,
    "discount_usage_top": _USAGE + " ORDER BY TransactionCount DESC, d.DiscountID LIMIT 10",
    "margin_overall": margin_report("OverallMarginPercentage").replace(
        "SELECT ", "SELECT 'All Sales' AS Category, ", 1),
    "margin_by_category": margin_report("CategoryMarginPercentage", "Category"),
    "margin_by_discount": margin_report(
        "MarginPercentage",
        "CASE WHEN DiscountID IS NOT NULL THEN 'Discounted' ELSE 'Regular Price' END AS PriceType"),
    "margin_buckets": f"""SELECT CASE WHEN ContributionMarginPercentage < 0 THEN 'Negative Margin'
            WHEN ContributionMarginPercentage < 20 THEN 'Low (0-20%)'
            WHEN ContributionMarginPercentage < 40 THEN 'Medium (20-40%)'
            WHEN ContributionMarginPercentage < 60 THEN 'Good (40-60%)'
            WHEN ContributionMarginPercentage < 80 THEN 'High (60-80%)'
            ELSE 'Very High (80%+)' END AS MarginBucket, count(*) AS LineItemCount,
        {money('sum(LineTotalUSD)')} AS TotalRevenue,
        {mean('ContributionMarginPercentage')} AS AvgMarginPercentage
        FROM items WHERE TransactionType = 'Sale' AND LineTotalUSD > 0
            AND ContributionMarginPercentage IS NOT NULL GROUP BY 1""",
    "rfm_distribution": "SELECT RFM_Segment, count(*) AS \"count\" FROM segments GROUP BY 1",
    "age_distribution": "SELECT AgeGroup, count(*) AS \"count\" FROM g_customers GROUP BY 1",
    "age_spending": f"""SELECT AgeGroup, count(CustomerID) AS CustomerCount,
        {money('sum(TotalSpending)')} AS TotalRevenue, {mean('TotalSpending')} AS AvgRevenuePerCustomer,
        {mean('CAST(AverageSpending AS DECIMAL(14,4))')} AS AvgOrderValue FROM g_customers GROUP BY 1""",
    "segments_by_age": f"""SELECT AgeGroup, RFM_Segment, count(*) AS CustomerCount,
        {mean('TotalSpending')} AS AvgSpending, {mean('NoOfInvoices')} AS AvgPurchases
        FROM g_customers GROUP BY 1, 2""",
    "segments_by_country": f"""SELECT Country, RFM_Segment, count(*) AS CustomerCount,
        {money('sum(TotalSpending)')} AS TotalRevenue, {mean('TotalSpending')} AS AvgSpending
        FROM g_customers GROUP BY 1, 2""",
    "segment_metrics": f"""SELECT RFM_Segment, count(*) AS CustomerCount,
        {money('sum(TotalSpending)')} AS TotalRevenue,
        {ratio('sum(TotalSpending) * 100', '(SELECT sum(TotalSpending) FROM g_customers)', 2)} AS RevenuePercentage,
        {mean('Recency', 0)} AS AvgDaysSinceLastPurchase, {mean('NoOfInvoices', 1)} AS AvgPurchaseCount,
        {mean('CAST(AverageSpending AS DECIMAL(14,4))')} AS AvgOrderValue,
        {ratio('count(*) FILTER (WHERE IsParent) * 100', 'count(*)', 1)} AS ParentPercentage
        FROM g_customers GROUP BY 1""",
    "stores_by_country": f"""SELECT Country, count(*) AS StoreCount,
        {money('sum(TotalSalesUSD)')} AS CountryTotalSales, {mean('TotalSalesUSD')} AS AvgStoreRevenue,
        {mean('CAST(AverageMonthlyUSD AS DECIMAL(18,4))')} AS AvgMonthlyRevenue,
        {mean('CAST(ReturnRate AS DECIMAL(10,2))')} AS AvgReturnRate FROM g_stores GROUP BY 1""",
    "store_ranking": f"""SELECT {doubles('TotalSalesUSD', 'AverageMonthlyUSD', 'ReturnRate')} FROM (
        SELECT StoreID, StoreName, City, Country, TotalSalesUSD, AverageMonthlyUSD, TotalTransactions,
            ReturnRate, rank() OVER (ORDER BY TotalSalesUSD DESC NULLS LAST) AS SalesRank,
            rank() OVER (ORDER BY AverageMonthlyUSD DESC NULLS LAST) AS MonthlyRank,
            rank() OVER (ORDER BY ReturnRate NULLS FIRST) AS QualityRank FROM g_stores)""",
    "underperforming_stores": f"""SELECT {doubles('TotalSalesUSD', 'AverageMonthlyUSD', 'ReturnRate')}
        FROM (SELECT StoreID, StoreName, City, Country, TotalSalesUSD, AverageMonthlyUSD,
            TotalTransactions, NumberOfEmployees, ReturnRate FROM g_stores
            ORDER BY TotalSalesUSD NULLS FIRST, StoreID LIMIT 10)""",
    "product_sales": """SELECT p.ProductID, p.Category, p.SubCategory, DescriptionEN, p.Color, Sizes,
        CAST(p.ProductionCost AS DOUBLE) AS ProductionCost,
        CAST(coalesce(q, 0) AS BIGINT) AS TotalQuantitySold,
        CAST(coalesce(r, 0) AS DOUBLE) AS TotalRevenue, coalesce(u, 0) AS UniqueCustomers
        FROM s_products p LEFT JOIN (SELECT ProductID, sum(Quantity) AS q, sum(LineTotalUSD) AS r,
            count(DISTINCT CustomerID) AS u FROM items GROUP BY ProductID) s ON p.ProductID = s.ProductID""",
    "customer_by_id": "SELECT * FROM s_customers WHERE CustomerID = 42",
    "customer_by_email": "SELECT * FROM s_customers WHERE Email = 'user43@example.com' "
                         "ORDER BY CustomerID LIMIT 1",
    "customer_by_phone": "SELECT * FROM s_customers WHERE Telephone = '+333315' "
                         "ORDER BY CustomerID LIMIT 1",
    "customers_by_name": "SELECT CustomerID, Name, Gender, City, Country FROM s_customers "
                         "WHERE Name ILIKE 'ann%' ORDER BY CustomerID LIMIT 20",
    "customer_invoices": _INVOICES + " WHERE CustomerID = 42",
    "stored_customer_invoices": _INVOICES + " WHERE CustomerID = 42",
    "customers_by_name_ci_ai": """SELECT CustomerID,
        CASE WHEN CustomerID % 2 = 0 THEN translate(Name, 'An', 'Áñ') ELSE Name END AS Name, Gender, City, Country
        FROM s_customers WHERE Name ILIKE 'ann%' ORDER BY CustomerID LIMIT 20""",
    "stored_customer_lookups": " UNION ALL ".join(
        f"(SELECT {doubles('TotalSpending', 'AverageSpending')}, '{by}' AS Lookup FROM g_customers "
        f"WHERE {test} ORDER BY CustomerID LIMIT 1)" for by, test in {
            "id": "CustomerID = 42", "email": "Email = 'user43@example.com'", "phone": "Telephone = '+333315'",
        }.items()),
    "gold_customers_bucketed": f"SELECT {doubles('TotalSpending', 'AverageSpending')} FROM g_customers",
    "load_or_build": f"SELECT {doubles('ProductionCost')} FROM s_products",
    "spending_summary_merged": " UNION ALL ".join(
        f"""SELECT '{c}' AS metric, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 2) AS mean,
        round(stddev_samp(CAST({c} AS DOUBLE)), 2) AS stddev, round(CAST(min({c}) AS DOUBLE), 2) AS min,
        round(CAST(max({c}) AS DOUBLE), 2) AS max, true AS q25_within, true AS q50_within, true AS q75_within
        FROM invoices""" for c in ("InvoiceTotal", "InvoiceTotalUSD")),
}

_EXPORTED = {"customers": "gold_customers", "discounts": "silver_discounts", "employees": "silver_employees",
             "exchange_rates": "exchange_rates", "invoice_fact": "export_mapping",
             "invoice_line_items": "invoice_line_items", "products": "silver_products", "stores": "gold_stores"}
# only invoices have amounts beyond their column in this data; export_rejects shows it
_PLAIN |= {f"export_{name}": _PLAIN[query] for name, query in _EXPORTED.items()}

#: Rows of every table the stored flow writes; nothing in these tables is broken or rejected.
_FLOW_ROWS = {("silver", name): f"SELECT count(*) FROM s_{name}" for name in
              ("employees", "stores", "customers", "products", "discounts", "transactions")}
_FLOW_ROWS |= {("silver", f"{kind}_{name}"): "SELECT 0" for _, name in list(_FLOW_ROWS) for kind in ("broken", "rejected")}
_FLOW_ROWS |= {
    ("gold", "invoice_fact"): "SELECT count(*) FROM invoices",
    ("gold", "missing_rates"): f"SELECT count(*) FROM ({_PLAIN['fx_missing']})",
    ("gold", "invoice_line_items"): "SELECT count(*) FROM attached",
    ("gold", "key_violations"): f"SELECT count(*) FROM ({_PLAIN['gold_key_violations']})",
    ("gold", "stores"): "SELECT count(*) FROM g_stores",
    ("gold", "customer_metrics"): "SELECT count(DISTINCT CustomerID) FROM items",
    ("gold", "customers"): "SELECT count(*) FROM g_customers",
    ("gold", "segment_metrics"): f"SELECT count(*) FROM ({_PLAIN['segment_metrics']})",
}
_PLAIN["flow_report"] = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, n AS written_count, n AS read_count, true AS counts_match, "
    f"true AS types_match FROM ({count}) AS c(n)" for (layer, name), count in _FLOW_ROWS.items())

ORACLES: dict[str, str] = {name: with_tables(sql) for name, sql in _PLAIN.items()}
