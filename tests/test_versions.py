"""Stored tables that are never lost, refreshed by month; staged tables that go after their last reader."""

import datetime
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hemline import schemas
from hemline.operators import quality
from hemline.plans import flow, gold
from hemline.sources import delimited, staging, tables, versions
from hemline.sources.staging import Scope, stage

D = datetime.date


def folders(path):
    return {x for x in os.listdir(path) if x.startswith("v-")}


def test_replaced_table(spark, tmp_path):
    path = str(tmp_path / "t")
    report = versions.replace_table(spark.range(5), path)
    assert [(r.written_count, r.read_count, r.counts_match) for r in report.collect()] == [(5, 5, True)]
    # the new rows come from the old ones
    versions.replace_table(tables.read_table(spark, path).filter("id > 1"), path)
    assert {r.id for r in tables.read_table(spark, path).collect()} == {2, 3, 4}
    assert len(folders(path)) == 2
    versions.replace_table(spark.range(2), path)
    assert len(folders(path)) == 2, "one replaced version stays for readers at work"


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_table(spark.range(5), path)
    before = folders(path)
    bad = spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(
        F.raise_error(F.lit("broken")).cast("long")))
    with pytest.raises(Exception, match="broken"):
        versions.replace_table(bad, path)
    assert tables.read_table(spark, path).count() == 5 and folders(path) == before


def test_a_failed_check_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.replace_table(spark.range(5), path)
    before = folders(path)

    def short(df, folder, mode, fmt):
        tables.write_table(df.limit(1), folder, mode, fmt)
        return spark.range(1).select(F.lit(9).alias("written_count"), F.lit(1).alias("read_count"),
                                     F.lit(False).alias("counts_match"), F.lit(True).alias("types_match"))

    monkeypatch.setattr(tables, "write_verified", short)
    with pytest.raises(versions.WriteCheckFailed):
        versions.replace_table(spark.range(9), path)
    assert tables.read_table(spark, path).count() == 5 and folders(path) == before


# --- refresh -------------------------------------------------------------------

LINES = "id long, day date, amount long"


def lines(spark, *rows):
    return spark.createDataFrame([(i, D(y, m, d), a) for i, y, m, d, a in rows], LINES)


def refresh(path, df, factor):
    return versions.refresh_table(
        path, {"lines": (df, F.col("day")), "factor": (factor, None)},
        lambda t: t["lines"].crossJoin(t["factor"]).select("id", "day", (F.col("amount") * F.col("f")).alias("amount")),
        "day", "lines")


def stored(spark, path):
    return Counter(map(tuple, tables.read_table(spark, path).collect()))


def test_refresh_writes_changed_months_only(spark, tmp_path):
    path = str(tmp_path / "t")
    two, three = spark.createDataFrame([(2,)], "f long"), spark.createDataFrame([(3,)], "f long")
    rows = [(1, 2024, 1, 5, 10), (2, 2024, 1, 6, 20), (3, 2024, 2, 1, 30)]
    assert refresh(path, lines(spark, *rows), two).written == ["2024-01-01", "2024-02-01"]
    assert stored(spark, path) == Counter({(1, D(2024, 1, 5), 20): 1, (2, D(2024, 1, 6), 40): 1, (3, D(2024, 2, 1), 60): 1})
    old = versions.read_manifest(spark, path).folders
    # the same rows in another order change nothing
    done = refresh(path, lines(spark, *rows[::-1]), two)
    assert (done.written, done.dropped, done.report) == ([], [], None)
    # a month that comes late, and a row that changed
    rows = [rows[0], rows[1], (3, 2024, 2, 1, 31), (4, 2023, 12, 31, 7)]
    assert refresh(path, lines(spark, *rows), two).written == ["2023-12-01", "2024-02-01"]
    assert stored(spark, path) == Counter({(1, D(2024, 1, 5), 20): 1, (2, D(2024, 1, 6), 40): 1,
                                           (3, D(2024, 2, 1), 62): 1, (4, D(2023, 12, 31), 14): 1})
    now = versions.read_manifest(spark, path).folders
    assert now["2024-01-01"] == old["2024-01-01"] and now["2024-02-01"] != old["2024-02-01"]
    # a month that is gone, a repeated row, then another factor for all months
    rows = [rows[0], rows[0], rows[3]]
    done = refresh(path, lines(spark, *rows), two)
    assert (done.written, done.dropped) == (["2024-01-01"], ["2024-02-01"])
    assert stored(spark, path) == Counter({(1, D(2024, 1, 5), 20): 2, (4, D(2023, 12, 31), 14): 1})
    assert refresh(path, lines(spark, *rows), three).written == ["2023-12-01", "2024-01-01"]
    assert stored(spark, path) == Counter({(1, D(2024, 1, 5), 30): 2, (4, D(2023, 12, 31), 21): 1})
    refresh(path, lines(spark), three)
    assert stored(spark, path) == Counter() and tables.read_table(spark, path).columns == ["id", "day", "amount"]


def test_a_failed_refresh_leaves_the_old_months(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,)], "f long")
    refresh(path, lines(spark, (1, 2024, 1, 5, 10)), one)
    bad = lines(spark, (1, 2024, 1, 5, 10), (2, 2024, 2, 5, 0)).withColumn(
        "amount", F.when(F.col("amount") > 0, F.col("amount")).otherwise(F.raise_error(F.lit("broken")).cast("long")))
    with pytest.raises(Exception, match="broken"):
        refresh(path, bad, one)
    assert stored(spark, path) == Counter({(1, D(2024, 1, 5), 10): 1})


# --- staging scope ---------------------------------------------------------------

def staged(spark):
    root = staging.staging_root(spark).removeprefix("file:")
    return set(os.listdir(root))


def test_scope_deletes_after_the_last_reader(spark):
    before = staged(spark)
    with Scope(spark) as outer:
        with Scope(spark) as scope:
            a, b = stage(spark.range(10), "a"), stage(spark.range(3), "b")
            both = scope.keep(a.join(b, "id"))  # still reads both
            stage(both, "c")
        assert len(staged(spark) - before) == 2 and both.count() == 3
        kept = outer.keep(stage(both, "d"))
        assert len(staged(spark) - before) == 3
    assert len(staged(spark) - before) == 1 and kept.count() == 3
    with pytest.raises(ValueError):
        with Scope(spark):
            stage(spark.range(2), "e")
            raise ValueError
    assert len(staged(spark) - before) == 1


def test_gold_leaves_nothing_staged(spark, data):
    import __spark_entry__ as entry

    before = staged(spark)
    with Scope(spark) as scope:
        shop = entry.Shop(spark, data)
        scope.keep(stage(shop.gold_customers, "customers"))
    assert {x.rsplit("-", 1)[0] for x in staged(spark) - before} == {"customers"}


# --- copies and keys ---------------------------------------------------------------

@pytest.mark.parametrize("bits", [quality.REPEAT_BITS, 64, 1])
def test_copies_by_key(spark, bits):
    """However full the filter is: rows of one key that differ stay, equal ones collapse, nulls are keys."""
    rows = [("a", 1, 5.0), ("a", 1, 5.0), ("a", 1, 6.0), ("b", 2, None), ("b", 2, None), (None, 1, 1.0), (None, 1, 1.0),
            (None, None, 1.0), ("c", None, 2.0), ("d", 4, 4.0)] + [("hot", 7, 7.0)] * 50 + [("hot", 7, float(k)) for k in range(50)]
    df = spark.createDataFrame(rows, "k string, n int, v double").repartition(4)
    got = quality.drop_duplicate_rows(df, "k", "n", bits=bits)
    assert Counter(map(tuple, got.collect())) == Counter(set(rows)) and got.columns == df.columns
    assert quality.drop_duplicate_rows(df.limit(0), "k", "n", bits=bits).collect() == []
    keys = Counter((k, n) for k, n, _ in rows)
    assert {tuple(r) for r in quality.key_violations(df, "k", "n", bits=bits).collect()} == {
        (*k, c) for k, c in keys.items() if c > 1}


# --- delimited text ------------------------------------------------------------------

LAYOUT = schemas._layout("CustomerID", CustomerID="integer", Email="string", DateOfBirth="date")


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def test_columns_are_found_by_name(spark, tmp_path):
    path = put(tmp_path / "a", "1.csv", 'Email,Extra,DateOfBirth,CustomerID\n"a@x","?",1990-01-02,7\n')
    assert [tuple(r) for r in delimited.read_csv(spark, path, LAYOUT).collect()] == [(7, "a@x", D(1990, 1, 2))]
    path = put(tmp_path / "b", "1.csv", "Email,CustomerID\na@x,7\n")
    with pytest.raises(delimited.HeaderMismatch, match="DateOfBirth"):
        delimited.read_csv(spark, path, LAYOUT)
    put(tmp_path / "c", "1.csv", "CustomerID,Email,DateOfBirth\n1,a@x,1990-01-02\n")
    path = put(tmp_path / "c", "2.csv", "Email,CustomerID,DateOfBirth\nb@x,2,1990-01-02\n")
    with pytest.raises(Exception, match="(?i)header"):  # two orders in one table
        delimited.read_csv(spark, path, LAYOUT).collect()


def test_broken_records_are_kept_as_text(spark, tmp_path):
    path = put(tmp_path / "a", "1.csv", "CustomerID,Email,DateOfBirth\n1,a@x,1990-01-02\n2,b@x\n3,c@x,1990-01-02,more\n4,,\n")
    text = delimited.read_csv_text(spark, path, LAYOUT, records=True)
    assert {tuple(r) for r in delimited.broken_records(text).collect()} == {("2,b@x", 2), ("3,c@x,1990-01-02,more", 3)}
    whole = delimited.whole_records(text)
    assert {r.CustomerID for r in whole.collect()} == {"1", "4"} and whole.columns == LAYOUT.names
    assert whole.count() == 2  # whatever columns are read


def test_refreshed_invoices_of_an_append_environment(spark, data, tmp_path):
    import __spark_entry__ as entry

    shop, path = entry.Shop(spark, data), str(tmp_path / "invoices")
    late = F.trunc(F.to_date("Timestamp"), "month") == F.lit(D(1996, 3, 1))
    lines = stage(shop.transactions, "lines")
    flow.refresh_invoices(path, lines.filter(~late), shop.places, shop.rates)
    done = flow.refresh_invoices(path, lines, shop.places, shop.rates)
    assert done.written == ["1996-03-01"]
    full = gold.invoice_fact(lines, shop.places, shop.rates)
    assert Counter(map(tuple, tables.read_table(spark, path).collect())) == Counter(map(tuple, full.collect()))
    assert tables.read_table(spark, path).schema == full.schema
