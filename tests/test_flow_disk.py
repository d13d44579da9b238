"""What the stored flow holds on disk at a time: packed text, and nothing that a finished step was made of."""

import datetime
import glob
import os
import time

from pyspark.sql import functions as F

from hemline.operators import numbering
from hemline.plans import flow
from hemline.sources import delimited, staging, tables
from hemline.sources.tables import Catalog, read_table
from tests.test_flow import BRONZE

D = datetime.date


def test_text_is_packed_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(delimited, "FILE_RECORDS", 10)
    rows = [(i, None if i % 5 == 0 else f' "{i}", ü\\') for i in range(35)]
    df = spark.createDataFrame(rows, "id int, name string").coalesce(1)
    path = str(tmp_path / "t")
    delimited.write_csv(df, path)
    files = glob.glob(f"{path}/part-*")
    assert len(files) == 4 and all(f.endswith(".csv.gz") for f in files)
    assert sorted(map(tuple, delimited.read_csv(spark, path, df.schema).collect())) == sorted(rows)


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString("\n")
    return {b for b in blocks.splitlines() if b.startswith("shuffle_")}


def left_over(spark, before):
    for _ in range(100):  # the files are deleted beside the work
        if not shuffle_files(spark) - before:
            return set()
        time.sleep(0.1)
    return shuffle_files(spark) - before


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    df = spark.range(0, 1000, 1, 4).withColumn("k", F.col("id") % 7)
    held = df.repartition(5, "k")
    tables.write_table(held, str(tmp_path / "a"))
    tables.write_table(df, str(tmp_path / "b"), layout=tables.Layout(("k",), 3))
    delimited.write_csv(held, str(tmp_path / "c"))
    assert not left_over(spark, before)


def test_slices_are_numbered_as_one_sort(spark):
    texts = [None, "INV-1", "INV-10", "INV-2", "é", "a"]
    rows = [(texts[i * 7 % 6], None if i % 4 == 0 else i * 31 % 11 - 5, i) for i in range(120)]
    df = spark.createDataFrame(rows, "a string, b int, id int")
    plain = df.selectExpr("id", "row_number() OVER (ORDER BY a NULLS FIRST, b NULLS FIRST, id) AS n")
    expected = {r.id: r.n for r in plain.collect()}
    assert {r.id: r.n for r in numbering.number_slices(df, ["a", "b", "id"], "n", 4).collect()} == expected
    # equal keys fall into one slice, and no row is lost between slices
    some = numbering.number_slices(df, ["a"], "n", 4).orderBy("n").collect()
    assert [r.n for r in some] == list(range(1, 121)) and sorted(r.id for r in some) == list(range(120))
    assert [r.a for r in some] == [r.a for r in df.orderBy(F.asc_nulls_first("a")).collect()]
    assert numbering.number_slices(df.limit(0), ["a", "id"], "n", 3).count() == 0


def test_what_a_table_was_made_of_goes_before_the_next_one(spark, tmp_path, monkeypatch):
    root = staging.staging_root(spark).removeprefix("file:")
    before, held, sorts = set(os.listdir(root)), {}, []
    replace, numbered = flow.replace_table, numbering._numbered

    def watched(df, path, *args, **kwargs):
        held[path.split("/")[-2], path.split("/")[-1]] = {d.rsplit("-", 1)[0] for d in set(os.listdir(root)) - before}
        return replace(df, path, *args, **kwargs)

    def counted(df, order, name, earlier=0):
        rows, n = numbered(df, order, name, earlier)
        sorts.append((name, n))
        return rows, n

    monkeypatch.setattr(flow, "replace_table", watched)
    monkeypatch.setattr(numbering, "_numbered", counted)
    monkeypatch.setattr(flow, "table_bytes", lambda df: 2 * flow.SORTED_BYTES)
    for name, text in BRONZE.items():
        (tmp_path / "bronze" / name).mkdir(parents=True)
        (tmp_path / "bronze" / name / "part.csv").write_text(text, encoding="utf-8")
    catalog = Catalog(str(tmp_path))
    flow.run_silver(spark, catalog)
    feed = spark.createDataFrame([], "RateDate date, TargetCurrency string, Rate decimal(18,8)")
    flow.run_gold(spark, catalog, feed, D(2024, 1, 1), D(2024, 12, 31))

    for name in BRONZE:
        assert {d for d in held["silver", name] if d.startswith("typed-")} == {f"typed-{name}"}
    # the joined lines go when they are sorted, the sorted ones when the table is written
    assert held["gold", "invoice_line_items"] == {"numbered", "promotion-months"}
    assert held["gold", "customer_metrics"] == set()
    assert set(os.listdir(root)) == before
    lines = read_table(spark, catalog.gold("invoice_line_items")).orderBy("LineItemID").collect()
    assert [(r.LineItemID, r.InvoiceID, r.Line) for r in lines] == [
        (1, "INV-1", 1), (2, "INV-1", 2), (3, "INV-2", 1), (4, "RET-1", 1)]
    slices = [n for name, n in sorts if name == "LineItemID"]
    assert len(slices) == 2 and sum(slices) == 4
