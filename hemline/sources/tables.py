"""Layered tables: where they are, how they are read, written and verified."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from hemline.operators.quality import column_types, enforce_schema
from hemline.sources.staging import COMPRESSION, freed_shuffles, stage

# How a run of each environment writes.
WRITE_MODES = {"dev": "overwrite", "test": "overwrite", "prod": "append"}

# Table options when the format is delta.
DELTA_OPTIONS = {
    "delta.autoOptimize.optimizeWrite": "true",
    "delta.autoOptimize.autoCompact": "true",
    "overwriteSchema": "true",
}


@dataclass(frozen=True)
class Layout:
    """How rows lie in a stored table's files, for the joins and lookups it serves.

    ``bucket_by``: rows dealt by hash into ``buckets`` files and sorted in each, so joins and
    groupings on these columns need no exchange and a lookup opens one file. For unique keys:
    a repeated one makes its bucket larger. The number of buckets should follow the table's
    size, a few hundred MB each. ``range_by``: rows sorted over all files, so a lookup
    by the first column reads the row groups that hold it; a hot value takes several files.
    ``bloom``: columns with a Parquet Bloom filter by row group, sized by what the group holds,
    so a lookup by value skips the groups without it.
    """

    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    range_by: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()

    def __post_init__(self):
        if self.bucket_by and self.range_by:
            raise ValueError("rows lie in buckets or in ranges, not both")
        if bool(self.bucket_by) != (self.buckets > 0):
            raise ValueError("buckets need columns and a number")

    def options(self) -> dict[str, str]:
        if not self.bloom:
            return {}
        return {"parquet.bloom.filter.adaptive.enabled": "true"} | {
            f"parquet.bloom.filter.enabled#{c}": "true" for c in self.bloom}


def write_mode(environment: str) -> str:
    return WRITE_MODES.get(environment, "overwrite")


@dataclass(frozen=True)
class Catalog:
    """Paths of the layers under one root; the format applies to silver and gold."""

    root: str
    fmt: str = "parquet"

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               fmt: str = "parquet", bare: tuple[str, ...] = ()) -> DataFrame:
    """Scan a stored table, versioned or plain; with a schema, conform to it and check required columns.

    Columns named ``bare`` are checked without hiding them from the scan.
    """
    from hemline.sources.versions import read_version

    df = read_version(spark, path, fmt)
    if df is None:
        df = spark.read.format(fmt).load(path)
    return enforce_schema(df, schema, bare) if schema is not None else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Redistribute an input whose files give fewer tasks than there are cores.

    A table of a few small files would otherwise keep one core busy through every stage up
    to the next shuffle. A table with enough files is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.select(*keys).rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: tuple[str, ...] = (), layout: Layout = Layout()) -> None:
    """Write with as many tasks as the data has partitions.

    Files are as large as the last exchange makes them (adaptive coalescing
    merges small ones), never one file per table. Ranges are cut by a sample of the
    rows, which are staged so that they are not built twice. The shuffle files go with the write.
    """
    if layout.bucket_by:
        df = df.repartition(layout.buckets, *layout.bucket_by)
    if layout.range_by:
        df = stage(df, "unsorted").repartitionByRange(*layout.range_by).sortWithinPartitions(*layout.range_by)
    writer = df.write.format(fmt).mode(mode).options(**layout.options())
    if fmt == "delta":
        writer = writer.options(**DELTA_OPTIONS)
    if fmt == "parquet":
        writer = writer.option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with freed_shuffles(df.sparkSession):
        if not layout.bucket_by:
            writer.save(path)
            return
        # only a named table can be written in buckets; the name goes, its files stay
        name = f"hemline_write_{uuid.uuid4().hex}"
        try:
            writer.bucketBy(layout.buckets, *layout.bucket_by).sortBy(*layout.bucket_by).option("path", path).saveAsTable(name)
        finally:
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def bucketed_table(spark: SparkSession, path: str, schema: StructType, columns: list[str], buckets: int,
                   fmt: str = "parquet") -> DataFrame:
    """A folder written in buckets, under a name of the session's catalog that tells its buckets.

    The name follows from the folder, so reading it again finds the same one; dropping it keeps the files.
    """
    name = bucketed_name(path)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING {fmt} CLUSTERED BY ({keys}) "
              f"SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def bucketed_name(path: str) -> str:
    return f"hemline_{hashlib.sha256(path.encode()).hexdigest()[:32]}"


def write_verified(df: DataFrame, path: str, mode: str = "overwrite",
                   fmt: str = "parquet", layout: Layout = Layout()) -> DataFrame:
    """Write, read back, and report both row counts and whether types survived.

    The written count is observed during the write, not by a second run. An
    append is compared with the rows that were there before plus the new ones.
    """
    spark = df.sparkSession
    stored = read_if_exists(spark, path, fmt) if mode == "append" else None
    earlier = stored.count() if stored is not None else 0
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, mode, fmt, layout=layout)
    written = earlier + seen.get["rows"]
    back = read_if_exists(spark, path, fmt)
    if back is None:  # buckets without rows have no files
        back = spark.createDataFrame([], df.schema)
    same_types = column_types(back.schema) == column_types(df.schema)
    return back.agg(F.count(F.lit(1)).alias("read_count")).select(
        F.lit(written).cast("long").alias("written_count"),
        "read_count",
        (F.col("read_count") == written).alias("counts_match"),
        F.lit(same_types).alias("types_match"),
    )


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The stored table, or None where there is no folder or no file in it."""
    from hemline.sources.versions import read_version

    versioned = read_version(spark, path, fmt)
    if versioned is not None:
        return versioned
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                  schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a stored table, or build, store and read it if it is not there."""
    if read_if_exists(spark, path, fmt) is None:
        write_table(build(), path, fmt=fmt)
    return read_table(spark, path, schema, fmt)


def extend_table(spark: SparkSession, path: str, rows: DataFrame, keys: list[str],
                 schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Append the rows whose key is not stored yet, and read the table.

    The new rows are staged first, so the append does not read what it writes to.
    """
    stored = read_if_exists(spark, path, fmt)
    if stored is None:
        write_table(rows, path, fmt=fmt)
    else:
        fresh = stage(rows.join(stored.select(*keys), keys, "left_anti").select(*rows.columns), "fresh-rows")
        write_table(fresh, path, "append", fmt)
    return read_table(spark, path, schema, fmt)


def promote_table(spark: SparkSession, source: str, target: str, schema: StructType,
                  mode: str = "overwrite", fmt: str = "parquet") -> DataFrame:
    """Copy a silver table unchanged to gold, conforming to its schema."""
    from hemline.sources.versions import replace_table

    rows = read_table(spark, source, schema, fmt)
    if mode == "overwrite":
        replace_table(rows, target, fmt)
    else:
        write_table(rows, target, mode, fmt)
    return read_table(spark, target, fmt=fmt)
