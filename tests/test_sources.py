"""CSV, stored tables, JDBC options and staging."""

import pytest
from pyspark.sql import functions as F

from hemline import schemas
from hemline.sources import delimited, jdbc, staging, tables


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_csv_reads_the_exchange_form(spark, tmp_path):
    file = tmp_path / "e.csv"
    file.write_text('"EmployeeID","StoreID","Name","Position"\n"1","2","Ann",""\n"2","1","","x"\n'
                    '"z","1","O\\"Neil","q,1"\n3,,Bare,\n', encoding="utf-8")
    got = rows(delimited.read_csv(spark, str(file), schemas.EMPLOYEES))
    assert got == [(1, 2, "Ann", None), (2, 1, None, "x"), (None, 1, 'O"Neil', "q,1"),
                   (3, None, "Bare", None)]


def test_csv_roundtrip_keeps_text(spark, tmp_path):
    texts = [' lead', 'trail ', 'a "quote"', 'comma, here', 'back\\slash', '电话']
    df = spark.createDataFrame([(i, 1, t, None) for i, t in enumerate(texts)],
                               "EmployeeID int, StoreID int, Name string, Position string")
    delimited.write_csv(df, str(tmp_path / "out"))
    back = delimited.read_csv(spark, str(tmp_path / "out"), schemas.EMPLOYEES)
    assert sorted(rows(back)) == rows(df)


def test_write_modes():
    assert [tables.write_mode(e) for e in ("dev", "test", "prod", "other")] == [
        "overwrite", "overwrite", "append", "overwrite"]


def test_write_verified(spark, tmp_path):
    df, path = spark.range(0, 100, 1, 4), str(tmp_path / "t")
    assert rows(tables.write_verified(df, path)) == [(100, 100, True, True)]
    assert rows(tables.write_verified(df, path, mode="append")) == [(200, 200, True, True)]
    assert rows(tables.write_verified(df, path, mode="overwrite")) == [(100, 100, True, True)]


def test_load_or_build(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert tables.read_if_exists(spark, path) is None
    for _ in range(2):
        assert tables.load_or_build(spark, path, build).count() == 3
    assert len(calls) == 1


def test_a_failing_build_is_not_hidden(spark, tmp_path):
    with pytest.raises(ZeroDivisionError):
        tables.load_or_build(spark, str(tmp_path / "t"), lambda: 1 / 0)


def test_promote_checks_required_columns(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    df = spark.createDataFrame([(1, 1, "x", "p")], "EmployeeID int, StoreID int, Name string, Position string")
    tables.write_table(df, a)
    assert rows(tables.promote_table(spark, a, b, schemas.EMPLOYEES)) == rows(df)
    tables.write_table(df.withColumn("Name", F.lit(None).cast("string")), a)
    with pytest.raises(Exception, match="NULL in required column Name"):
        tables.promote_table(spark, a, b, schemas.EMPLOYEES)


def test_extend_adds_only_what_is_missing(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "other"), (3, "c")], "k int, v string")
    assert sorted(rows(tables.extend_table(spark, path, old, ["k"]))) == rows(old)
    for _ in range(2):
        out = tables.extend_table(spark, path, new, ["k"])
        assert sorted((r.k, r.v) for r in out.collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_jdbc_options():
    assert jdbc.split_options("CustomerID", 1, 100, 8) == {
        "partitionColumn": "CustomerID", "lowerBound": "1", "upperBound": "100", "numPartitions": "8"}
    with pytest.raises(ValueError):
        jdbc.split_options("CustomerID", 5, 1, 8)
    assert jdbc.Database("jdbc:x", schema="Shop").table("Stores") == "Shop.Stores"
    assert sorted(jdbc.LANDED_TABLES.values()) == sorted(schemas.BRONZE)


def test_stage(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    out = staging.stage(df, "t")
    assert sorted(rows(out)) == rows(df) and out.schema.names == df.schema.names
    assert staging.stage(df.limit(0), "t").count() == 0
    assert all(f.startswith(("file:", "/")) for f in out.inputFiles())


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_root(Session())
    Session.conf.get = staticmethod(lambda name, default: "hdfs://shared/dir/")
    assert staging.staging_root(Session()) == "hdfs://shared/dir"
