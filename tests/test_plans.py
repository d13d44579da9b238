"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as entry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shop(spark, data):
    return entry.Shop(spark, data)


LARGE = ["transactions", "customers", "products", "invoices", "line_dims", "lines", "enriched",
         "gold_customers", "store_metrics", "gold_stores"]


@pytest.mark.parametrize("name", LARGE)
def test_no_python_no_rdd_no_single_task(shop, name):
    text = plan(getattr(shop, name))
    for forbidden in ("BatchEvalPython", "ArrowEvalPython", "ExistingRDD", "SinglePartition",
                      "CartesianProduct", "BroadcastNestedLoopJoin"):
        if forbidden == "SinglePartition" and name == "gold_customers":
            continue  # the reference day is one maximum over per-task maxima
        assert forbidden not in text, f"{forbidden} in {name}:\n{text}"


def test_numbered_tables_are_plain_scans(shop):
    """Once staged, numbers need no exchange, window or join."""
    text = plan(entry.gold.number_line_items(shop.lines))
    for step in ("Exchange", "Window", "Join", "Sort"):
        assert step not in text


def test_scans_read_only_what_is_used(shop):
    text = plan(entry.reports.margin_by_category(shop.lines))
    # rows whose key occurs once come first; only suspects are compared in all bronze columns
    line_scan = next(x for x in text.splitlines() if "lineitem.parquet" in x)
    for unused in ("l_tax", "l_returnflag", "l_shipdate", "l_linestatus"):
        assert unused not in line_scan
    assert "nation.parquet" not in text  # no report on margins needs the stores
    part_scan = next(x for x in text.splitlines() if "part.parquet" in x)
    assert "p_size" not in part_scan and "p_name" not in part_scan


def test_only_suspected_copies_are_exchanged_over_all_columns(shop):
    """Above the filter over repeated keys, which suspects alone pass, and nowhere else."""
    text = plan(shop.transactions).splitlines()
    wide = [i for i, x in enumerate(text) if "Exchange hashpartitioning" in x and x.count(",") > 15]
    assert len(wide) == 1
    assert any("getbit" in x for x in text[wide[0]:]) and any("Union" in x for x in text[:wide[0]])
    once = text[next(i for i, x in enumerate(text) if "Union" in x):wide[0]]
    assert not any("Exchange hashpartitioning" in x and "SKU" in x for x in once)


def test_dimension_joins_shuffle_when_they_are_large(spark, shop):
    """Without small sides every join falls back to a shuffle, none to nested loops."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry.reports.margin_by_category(entry.Shop(spark, shop.folder).lines))
        # the filter over repeated keys has 16 MB at most, whatever the tables' sizes
        assert all("_bucket#" in x for x in text.splitlines() if "BroadcastHashJoin" in x) and "SortMergeJoin" in text
        assert "NestedLoop" not in text and "Cartesian" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_same_result_without_broadcasts(spark, data, shop):
    """The shuffled plan gives the broadcast plan's rows."""
    def result():
        t = entry.Shop(spark, data)
        return sorted(map(tuple, entry.reports.discount_usage(t.discounts, t.lines).collect()))

    usual = result()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert result() == usual
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name,key", [("product_sales", "ProductID"), ("store_metrics", "StoreID")])
def test_grouping_does_not_inherit_a_join_partitioning(spark, data, name, key):
    """Between the join on a key and the grouping below it there is an exchange."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = entry.Shop(spark, data)
        lines = entry.usd_lines(t)
        # the join on the key comes last
        lines = (lines.drop("Category").join(t.products.select("ProductID", "Category"), "ProductID")
                 if key == "ProductID" else
                 lines.drop("City").join(t.places.select("StoreID", "City"), "StoreID"))
        df = (entry.lookups.product_sales(t.products, lines) if key == "ProductID"
              else entry.gold.store_metrics(lines))
        steps = [x for x in plan(df).splitlines() if "HashAggregate" in x or "Exchange" in x]
        first = next(i for i, x in enumerate(steps) if "keys=[_groupingexpression" in x and "partial_" in x)
        assert "Exchange hashpartitioning(_groupingexpression" in steps[first - 1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
