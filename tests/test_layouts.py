"""Stored tables laid out for joins and lookups, and summaries that merge."""

import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from hemline import schemas
from hemline.operators import sketches
from hemline.operators.quality import enforce_schema
from hemline.plans import gold, lookups
from hemline.sources import tables, versions
from hemline.sources.tables import Layout


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_read(df):
    """Rows that the scan hands on after skipping what statistics and Bloom filters rule out."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def people(spark, n):
    k = F.col("id")
    return gold.shaped(spark.range(1, n + 1).select(
        k.alias("CustomerID"), F.concat(F.lit("Name "), k).alias("Name"),
        F.concat(F.sha1(k.cast("string")), F.lit("@example.com")).alias("Email"),
        F.concat(F.lit("+"), F.crc32(k.cast("string"))).alias("Telephone"),
        F.lit("Porto").alias("City"), F.lit("Portugal").alias("Country"), F.lit("F").alias("Gender"),
        F.lit("1980-01-01").alias("DateOfBirth"), F.lit("clerk").alias("JobTitle")), schemas.CUSTOMERS)


def metrics(spark, n):
    k = F.col("id")
    return spark.range(1, n + 1).filter("id % 3 > 0").select(
        k.cast("int").alias("CustomerID"), k.cast("decimal(20,4)").alias("TotalSpending"),
        (k % 7 + 1).alias("NoOfInvoices"), F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int"))
        .alias("LastPurchaseDate"), F.lit("2024-12-02").cast("date").alias("LastActivityDate"), (k % 4).alias("ChildrenPurchases"),
        (k / 2).cast("decimal(14,4)").alias("AverageSpending"))


def test_bucketed_customers_join_as_they_lie(spark, tmp_path, no_broadcast):
    layout = Layout(("CustomerID",), 8)
    a, b = str(tmp_path / "customers"), str(tmp_path / "metrics")
    versions.replace_table(people(spark, 500), a, layout=layout)
    versions.replace_table(metrics(spark, 500), b, layout=layout)
    left = tables.read_table(spark, a, schemas.CUSTOMERS, bare=("CustomerID",))
    right = tables.read_table(spark, b)
    enriched = gold.enrich_spending(left, right)
    assert "Exchange" not in plan(enriched) and "SortMergeJoin" in plan(enriched)
    whole = gold.gold_customers(left, right)
    shuffles = [x for x in plan(whole).splitlines() if "Exchange hashpartitioning(CustomerID" in x]
    # the scores come back from their sort; customers and metrics stay where they lie
    assert len(shuffles) == 1
    after = plan(whole).split(shuffles[0])[1]
    assert "_metric" in after and "customers" not in after.split("FileScan")[1]
    plainly = gold.gold_customers(people(spark, 500), metrics(spark, 500))
    assert sorted(map(str, whole.collect())) == sorted(map(str, plainly.collect()))


def test_a_bare_required_column_is_still_checked(spark):
    layout = schemas.CUSTOMERS
    bad = people(spark, 3).withColumn("CustomerID", F.when(F.col("CustomerID") != 2, F.col("CustomerID")))
    with pytest.raises(Exception, match="NULL in required column CustomerID"):
        enforce_schema(bad, layout, ("CustomerID",)).collect()
    assert enforce_schema(people(spark, 3), layout, ("CustomerID",)).count() == 3


def test_lookups_skip_what_cannot_match(spark, tmp_path):
    path, n = str(tmp_path / "customers"), 40_000
    versions.replace_table(people(spark, n), path, layout=Layout(("CustomerID",), 8, bloom=("Email", "Telephone")))
    stored = tables.read_table(spark, path)
    one = people(spark, n).filter("CustomerID = 777").first()
    for found in (lookups.customer_by_id(stored, 777), lookups.customer_by_email(stored, one.Email),
                  lookups.customer_by_phone(stored, one.Telephone)):
        assert [r.CustomerID for r in found.collect()] == [777]
        # one bucket of eight, give or take a false positive of a Bloom filter
        assert rows_read(found) <= n / 8 * 3
    assert lookups.customer_by_email(stored, "nobody").collect() == []
    unfiltered = str(tmp_path / "unfiltered")
    versions.replace_table(people(spark, n), unfiltered, layout=Layout(("CustomerID",), 8))
    # without Bloom filters every file's range of mails holds the one sought
    assert rows_read(lookups.customer_by_email(tables.read_table(spark, unfiltered), one.Email)) > n / 2


def test_a_busy_customer_takes_several_files(spark, tmp_path):
    path, n = str(tmp_path / "invoices"), 60_000
    busy = F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 9000)
    rows = spark.range(n).select(busy.alias("CustomerID"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 365)
                                 .cast("int")).alias("Date"), F.col("id").alias("InvoiceID"))
    versions.replace_table(rows, path, layout=Layout(range_by=("CustomerID", "Date", "InvoiceID")))
    stored = tables.read_table(spark, path)
    assert stored.count() == n
    files = stored.select("CustomerID", F.col("_metadata.file_path").alias("f"))
    sizes = [r["n"] for r in files.groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect()]
    # small files may be merged, but the customer with a third of all rows fills no file of their own alone
    assert max(sizes) < n / 2 or len(sizes) == 1
    assert rows_read(stored.filter("CustomerID = 8000")) < n / 2 or len(sizes) == 1


def test_bucketed_table_is_replaced(spark, tmp_path):
    path, layout = str(tmp_path / "t"), Layout(("id",), 4)
    for n in (5, 9, 2):
        versions.replace_table(spark.range(n), path, layout=layout)
        assert tables.read_table(spark, path).count() == n
    # a table may be read while it is replaced, and its layout may change
    versions.replace_table(tables.read_table(spark, path).filter("id > 0"), path)
    assert [r.id for r in tables.read_table(spark, path).collect()] == [1]
    assert len([x for x in os.listdir(path) if x.startswith("v-")]) == 2
    # the version kept for readers at work still has its name, retired ones lost theirs
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith("hemline_write_")]
    assert names == []
    versions.replace_table(spark.range(0), path, layout=layout)
    assert tables.read_table(spark, path).count() == 0


@pytest.mark.parametrize("bad", [dict(bucket_by=("a",)), dict(buckets=3),
                                 dict(bucket_by=("a",), buckets=2, range_by=("b",))])
def test_layouts_that_make_no_sense(bad):
    with pytest.raises(ValueError):
        Layout(**bad)


# --- summaries ---------------------------------------------------------------

def test_merged_summary_is_that_of_all_rows(spark):
    rng = random.Random(3)
    rows = [(i % 11, rng.lognormvariate(5, 2) if i % 13 else None) for i in range(30_000)]
    # one part holds a third of all rows, one nothing but nulls, some values are no numbers
    rows += [(3, float(i % 50)) for i in range(15_000)] + [(77, None)] * 20 + [(5, float("nan"))] * 7
    df = spark.createDataFrame(rows, "part int, x double")
    parts = sketches.part_summaries(df, "part", "x")
    assert parts.count() == 12
    merged = sketches.merged_summary(parts, "x")
    got = merged.first()
    values = sorted(x for _, x in rows if x is not None and x == x)
    assert got["count"] == len(values) and got["min"] == values[0] and got["max"] == values[-1]
    assert got["mean"] == pytest.approx(statistics.fmean(values))
    assert got["stddev"] == pytest.approx(statistics.stdev(values))
    assert list(sketches.quartiles_within(df, merged, "x", 3 * sketches.rank_error()).first())[1:] == [True] * 3
    # a check that can fail
    wrong = merged.withColumn("q50", F.col("q75"))
    assert sketches.quartiles_within(df, wrong, "x", 3 * sketches.rank_error()).first()["q50_within"] is False
    # merging two halves of the parts first changes no exact figure
    half = sketches.merged_summary(parts.filter("part < 5 OR part = 77"), "x").first()
    assert half["count"] == sum(1 for p, x in rows if (p < 5 or p == 77) and x is not None and x == x)


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "part int, x double")
    none = spark.createDataFrame([(1, None), (2, None)], "part int, x double")
    for df in (empty, none):
        row = sketches.merged_summary(sketches.part_summaries(df, "part", "x"), "x").first()
        assert row["count"] == 0 and all(row[c] is None for c in ("mean", "stddev", "min", "q25", "q50", "q75", "max"))


# --- names under a collation -------------------------------------------------

def test_names_under_a_collation(spark):
    df = people(spark, 6).withColumn("Name", F.element_at(F.array(
        *[F.lit(x) for x in ("Ánn Lee", "ANN B", "Bo Ann", "ann c", "Añn", "Zoë")]), F.col("CustomerID")))

    def ids(**how):
        return [r.CustomerID for r in lookups.customers_by_name(df, **how).collect()]

    assert ids(prefix="ann", collation="UNICODE_CI_AI") == [1, 2, 4, 5]
    assert ids(prefix="ann", collation="UNICODE_CI") == [2, 4]
    assert ids(prefix="ZOE", collation="UNICODE_CI_AI") == [6]
    assert ids(prefix="ann") == [2, 4] and ids(prefix="ann", case_sensitive=True) == [4]
    # accents typed as combining marks are the same letters
    assert ids(prefix="ánn", collation="UNICODE_CI_AI") == [1, 2, 4, 5]
