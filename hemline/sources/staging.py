"""Intermediate tables in the folder all executors share.

Used where a result is read more than once or where its exact size should reach
the optimizer. A staged table survives the loss of any executor. Inside a ``Scope`` it
is deleted after its last reader; without one it stays until its folder is cleared.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Only a local session without one gets a temporary folder; on a cluster a
    machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="hemline-"))
    return context.getCheckpointDir().rstrip("/")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark can write to; a missing one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_scope: ContextVar[Scope | None] = ContextVar("hemline-staging-scope", default=None)


class Scope:
    """The staged tables of a piece of work, and who still reads them.

    On leaving, every table written inside is deleted but those that a kept DataFrame
    reads. These pass to the scope around it, which deletes them when it is left in turn.

        with Scope(spark) as scope:
            found = scope.keep(stage(work(), "found"))

    A DataFrame that is not kept and read later fails: its files are gone. One that finds
    its staged tables through a scalar subquery must be staged itself before it is kept.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self._kept: list[DataFrame] = []

    def __enter__(self) -> Scope:
        self._token = _scope.set(self)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self._kept.append(df)
        return df

    def drop(self, *tables: DataFrame) -> None:
        """Delete staged tables of this scope that these DataFrames read, before the scope ends."""
        self._delete(reads(tables, self.paths))

    def close(self, *readers: DataFrame) -> list[str]:
        """Delete the tables that no reader needs any more; the others' paths are returned."""
        self._delete(set(self.paths) - reads(readers, self.paths))
        return self.paths

    def _delete(self, gone: set[str]) -> None:
        for path in gone:
            delete_folder(self.spark, path)
        self.paths = [p for p in self.paths if p not in gone]

    def __exit__(self, kind, *_) -> None:
        _scope.reset(self._token)
        left = self.close(*self._kept) if kind is None else self.close()
        around = _scope.get()
        if around is not None:
            around.paths += left


def reads(readers, paths: list[str]) -> set[str]:
    """Which of the staged tables the DataFrames read."""
    files = {f for df in readers for f in df.inputFiles()}
    names = {p.rsplit("/", 1)[1]: p for p in paths}
    return {names[part] for f in files for part in f.split("/")[-3:] if part in names}


def table_bytes(df: DataFrame) -> int:
    """Bytes on disk of a staged or stored table, as the optimizer knows them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


#: Spark's setting that lets a finished write delete its own shuffle files.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Writes inside delete their shuffle files when they are done, not when the driver's garbage is full."""
    before = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, before)


def staged_path(spark: SparkSession, label: str) -> str:
    """A new path under the staging folder, owned by the scope at work, if there is one."""
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.paths.append(path)
    return path


#: Staged tables are written and read about once, so their size on disk counts most; stored ones are packed alike.
COMPRESSION = "zstd"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new staged table and return it as read back."""
    spark = df.sparkSession
    path = staged_path(spark, label)
    with freed_shuffles(spark):
        df.write.parquet(path, compression=COMPRESSION)
    return spark.read.schema(df.schema).parquet(path)
