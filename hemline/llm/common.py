"""Helpers of the operators: staging, shipping the package, text blocks and word hashes.

Text reaches Python as Arrow batches and is handled as byte arrays: words are found by
a table of white-space bytes and hashed by differences of one prefix sum, so no Python
string is made for a word.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hemline.operators.quality import bit_set
from hemline.sources.staging import freed_shuffles, staged_path

#: White space of the contracts: blank and \x09-\x0D. Fixed values.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Base of the rolling hash (odd, so it has an inverse modulo 2**64).
BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Bytes of text handled at once; temporaries take about forty times that.
BLOCK = 1 << 20
#: Column of the number that ``numbered`` gives each row.
ROW = "__row"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, so that workers can import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="hemline-ship-"), "hemline.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and return it as read back."""
    spark = df.sparkSession
    path = staged_path(spark, label)
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """The rows staged with a number of their own in the column ROW, whatever their ids are."""
    return stage(df.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def chosen(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """The ``numbered`` rows whose numbers are listed, without their number.

    The list is staged as bitmaps of 32,768 numbers each, about a bit a row, so that it meets the rows by a
    broadcast, and no text is exchanged, up to far larger tables than it would as a list.
    """
    number = F.col(numbers.columns[0])
    listed = numbers.select(F.bitmap_bucket_number(number).alias("__bucket"), F.bitmap_bit_position(number).alias("__place"))
    marks = stage(listed.repartition("__bucket").groupBy("__bucket").agg(
        F.bitmap_construct_agg("__place").alias("__bits")), "chosen-rows")
    same = F.bitmap_bucket_number(rows[ROW]) == marks["__bucket"]
    return rows.join(marks, same & bit_set(marks["__bits"], rows[ROW]), "left_semi").drop(ROW)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_power_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, at least ``n`` of each, kept by the worker."""
    size = 1 << max(16, int(n - 1).bit_length())
    if size not in _power_tables:
        _power_tables.clear()
        _power_tables[size] = powers(BASE, size), powers(_INVERSE, size)
    return _power_tables[size]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Prefix sums of symbol * BASE**position, one more than there are symbols."""
    n = len(symbols)
    out = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * power_table(n + 1)[0][:n], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of each [start, end); equal content and length give equal hashes."""
    inverse = power_table(len(prefix))[1]
    with np.errstate(over="ignore"):
        raw = (prefix[end] - prefix[start]) * inverse[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Block:
    """Consecutive rows of a batch: their text bytes, and where each row starts."""

    def __init__(self, rows: pa.RecordBatch, data: np.ndarray, at: np.ndarray):
        self.rows, self.data, self.at = rows, data, at

    def __len__(self) -> int:
        return len(self.at) - 1

    def words(self, ink_table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and the number of words before each row.

        A word is a run of bytes that are not white space, or that the table marks.
        """
        ink = ~SPACE[self.data] if ink_table is None else ink_table[self.data]
        n = len(ink)
        begins, ends = ink.copy(), ink.copy()
        begins[1:] &= ~ink[:-1]
        ends[:-1] &= ~ink[1:]
        edges = self.at[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        begins[edges] = ink[edges]
        ends[edges - 1] = ink[edges - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        return start, end, np.searchsorted(start, self.at)

    def text(self, row: int) -> bytes:
        return self.data[self.at[row]:self.at[row + 1]].tobytes()


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK) -> Iterator[Block]:
    """Cut batches into blocks of about ``limit`` bytes; a longer row is a block alone.

    A null text counts as empty.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        n = len(texts)
        if not n:
            continue
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        row = 0
        while row < n:
            stop = int(np.searchsorted(at, at[row] + limit, side="right")) - 1
            stop = min(n, max(stop, row + 1))
            yield Block(batch.slice(row, stop - row), data[at[row]:at[stop]],
                        at[row:stop + 1] - at[row])
            row = stop


def list_array(values: np.ndarray, at: np.ndarray) -> pa.ListArray:
    """Values cut at ``at`` (one more than rows) as an Arrow list column."""
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values))
