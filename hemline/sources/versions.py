"""Stored tables that are replaced or extended without a moment in which they are lost.

A table's folder holds version folders that are never changed once written, and a small
manifest that names the folders that make up the table now. A writer writes a new version,
checks it, and only then replaces the manifest, so a write that fails at any point leaves
readers the old rows. A version may hold some partitions only; the manifest then takes the
others from earlier versions, so a refresh writes what changed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from hemline.sources import tables
from hemline.sources.staging import Scope, delete_folder

MANIFEST = "_manifest.json"
#: Column that splits a refreshed table; a date, the first of the month.
PART = "_month"


class WriteCheckFailed(RuntimeError):
    """What was read back is not what was written; the table is as it was."""


@dataclass
class Manifest:
    """``folders``: part (or '' for a whole table) -> version folder. ``digests``: part -> digest of its inputs.

    ``bucket_by`` and ``buckets`` tell how the rows of a whole table were dealt to its files.
    """

    schema: str
    folders: dict[str, str] = field(default_factory=dict)
    digests: dict[str, str] = field(default_factory=dict)
    earlier: list[str] = field(default_factory=list)
    bucket_by: list[str] = field(default_factory=list)
    buckets: int = 0


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    target, files = _file(spark, path)
    if not files.exists(target):
        return None
    size = files.getFileStatus(target).getLen()
    data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(files.open(target), size)
    return Manifest(**json.loads(bytes(data).decode()))


def _write_manifest(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Write beside the old manifest, then put it in its place with one rename."""
    target, files = _file(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}.{uuid.uuid4().hex}")
    out = files.create(beside, True)
    out.write(bytearray(json.dumps(manifest.__dict__).encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(context.makeQualified(beside), context.makeQualified(target), how)


def _new_version(path: str) -> str:
    return f"{path}/v-{uuid.uuid4().hex}"


def _swap(spark: SparkSession, path: str, old: Manifest | None, new: Manifest, keep: int) -> None:
    """Make ``new`` the table; versions that are in none of the last ``keep`` manifests before it go."""
    used = set(new.folders.values())
    retired = [f for f in (sorted(set(old.folders.values())) if old else []) if f not in used]
    waiting = (old.earlier if old else []) + (["|".join(retired)] if retired else [])
    gone, new.earlier = waiting[:max(0, len(waiting) - keep)], waiting[max(0, len(waiting) - keep):]
    _write_manifest(spark, path, new)
    for folder in {f for group in gone for f in group.split("|")} - used:
        spark.sql(f"DROP TABLE IF EXISTS {tables.bucketed_name(folder)}")
        delete_folder(spark, folder)


def _checked(report: DataFrame, folder: str) -> DataFrame:
    row = report.first()
    if not (row["counts_match"] and row["types_match"]):
        delete_folder(report.sparkSession, folder)
        raise WriteCheckFailed(f"{folder}: {row}")
    return report


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", keep: int = 1,
                  layout: tables.Layout | None = None) -> DataFrame:
    """Write ``df`` as the new version of a table, check it, swap; returns the write check.

    ``df`` may read the table itself. ``keep`` replaced versions stay for readers at work.
    """
    spark = df.sparkSession
    folder = _new_version(path)
    extra = () if layout is None else (layout,)
    try:
        with Scope(spark):
            report = _checked(tables.write_verified(df, folder, "errorifexists", fmt, *extra), folder)
    except Exception:
        delete_folder(spark, folder)
        raise
    dealt = {} if layout is None else {"bucket_by": list(layout.bucket_by), "buckets": layout.buckets}
    _swap(spark, path, read_manifest(spark, path), Manifest(df.schema.json(), {"": folder}, **dealt), keep)
    return report


def read_version(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table as its manifest has it now; None without one."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        return None
    schema = StructType.fromJson(json.loads(manifest.schema))
    folders = [f if part == "" else f"{f}/{PART}={part}" for part, f in manifest.folders.items()]
    if not folders:
        return spark.createDataFrame([], schema)
    if manifest.buckets:
        return tables.bucketed_table(spark, folders[0], schema, manifest.bucket_by, manifest.buckets, fmt)
    return spark.read.format(fmt).schema(schema).load(folders)


# --- refresh by month --------------------------------------------------------

def month(day: Column) -> Column:
    return F.trunc(day, "month")


def digests(df: DataFrame, day: Column | None) -> DataFrame:
    """(part, digest): rows and a sum of row hashes by month, whatever the order of rows.

    Without a day there is one digest, part NULL, which belongs to every month.
    """
    part = F.lit(None).cast("string") if day is None else F.date_format(month(day), "yyyy-MM-dd")
    sums = df.select(part.alias("part"), F.xxhash64(*df.columns).cast("decimal(38,0)").alias("_h")).groupBy("part").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_h").alias("_s"))
    return sums.select("part", F.concat_ws(":", "_n", "_s").alias("digest"))


Digests = dict[str, dict[str | None, str]]


def collected_digests(inputs: Mapping[str, tuple[DataFrame, Column | None]]) -> Digests:
    """The digests of each input by month. Brings one short row per input and month to the driver."""
    return {name: {r["part"]: r["digest"] for r in digests(df, day).collect()}
            for name, (df, day) in inputs.items()}


def input_digests(found: Digests) -> dict[str, str]:
    """Per month one digest of all inputs."""
    shared = "|".join(f"{n}={d[None]}" for n, d in found.items() if None in d)
    months = {p for d in found.values() for p in d if p is not None}
    return {p: shared + "|" + "|".join(f"{n}={d[p]}" for n, d in found.items() if p in d) for p in sorted(months)}


@dataclass
class Refresh:
    """What a refresh did: months written, months dropped, and its write check (None if nothing was written)."""

    written: list[str]
    dropped: list[str]
    report: DataFrame | None


def refresh_table(path: str, inputs: Mapping[str, tuple[DataFrame, Column | None]],
                  build: Callable[[Mapping[str, DataFrame]], DataFrame], day: str, driving: str,
                  fmt: str = "parquet", keep: int = 1) -> Refresh:
    """Rebuild the months of a table whose inputs changed since they were last built.

    ``inputs``: tables with the day that puts their rows into months, or None for a table that
    concerns every month. ``build`` gets the inputs, those with a day cut to the changed months,
    and returns rows of these months by their column ``day``. A month without rows of the
    ``driving`` input leaves the table. The whole table is built when there is none yet.
    """
    spark = inputs[driving][0].sparkSession
    old = read_manifest(spark, path)
    found = collected_digests(inputs)
    now = {p: d for p, d in input_digests(found).items() if p in found[driving]}
    known = old.digests if old else {}
    changed = [p for p in now if known.get(p) != now[p]]
    dropped = [p for p in known if p not in now]
    if old is not None and not changed and not dropped:
        return Refresh([], [], None)
    report, folders = None, dict(old.folders) if old else {}
    schema = old.schema if old else None
    if changed or old is None:
        def cut(df: DataFrame, when: Column | None) -> DataFrame:
            return df if when is None else df.filter(month(when).isin([F.to_date(F.lit(p)) for p in changed]))

        rows = build({name: cut(df, when) for name, (df, when) in inputs.items()})
        if schema is not None and rows.schema.json() != schema:
            raise ValueError("the table's columns changed: replace it whole")
        schema = rows.schema.json()
        folder = _new_version(path)
        dealt = rows.withColumn(PART, F.date_format(month(F.col(day)), "yyyy-MM-dd"))
        try:
            tables.write_table(dealt.hint("rebalance", PART), folder, "errorifexists", fmt, (PART,))
            back = spark.read.format(fmt).schema(dealt.schema).load(folder)
            counts = {r[PART]: r["n"] for r in back.groupBy(F.col(PART).cast("string").alias(PART)).agg(
                F.count(F.lit(1)).alias("n")).collect()}
        except Exception:
            delete_folder(spark, folder)
            raise
        if not set(counts) <= set(changed):
            delete_folder(spark, folder)
            raise WriteCheckFailed(f"{folder}: rows of other months than {changed}")
        report = spark.createDataFrame(sorted(counts.items()), "part string, row_count long")
        folders |= {p: folder for p in counts}
        for p in changed:  # the month has inputs but no rows
            if p not in counts:
                folders.pop(p, None)
    for p in dropped:
        folders.pop(p, None)
    _swap(spark, path, old, Manifest(schema, folders, now), keep)
    return Refresh(changed, dropped, report)
