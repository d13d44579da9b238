"""Exact deduplication over a cuckoo-filter index of live digests.

Digests are SHA-256 values of normalised texts, computed by SQL functions. A ``LiveIndex``
deals them into buckets, as many as their number asks for. Stored with each bucket is a
cuckoo filter of its live digests, and beside the filters the content: the digests with
what is kept of their group. New digests go to the filters. Those that a filter does not
hold are new and never meet the content; each hit is verified against it. Digests can be
deleted, from content and filter. When an insertion finds no place, that bucket's filter
is made anew, larger, from the stored digests.

Copies are combined twice: in each scan partition before the shuffle, so that a text that
makes up a third of all rows sends a few rows per partition, then in the digest's bucket.
A task holds one bucket at a time, and ``FLUSH`` digests at most while it combines.

Null text counts as empty; empty texts equal each other. Rows of one text and one id are
separate rows of their group; all of them carry the kept id, and ``kept`` marks every row
with that id. A null id sorts after all others. ``unique_documents`` goes by rows instead:
one row of a group stays, also when ids repeat or are null. An empty table gives no rows.
Other columns may have any names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hemline.llm.common import ROW, chosen, numbered, ship, stage

SLOTS = 4
KICKS = 200
#: Digests that a bucket is made for.
BUCKET_ROWS = 1 << 15
#: Digests that a task combines before it sends them on.
FLUSH = 1 << 16
#: White space that normalisation deletes. Fixed values.
BLANKS = " \t\n\x0b\x0c\r"


class CuckooFilter:
    """Filter of 16-bit fingerprints of SHA-256 digests, four slots a cell.

    The second cell of a fingerprint follows from the first and the fingerprint alone, so
    entries move and go without their digest. ``insert`` is false when no place is found.
    """

    def __init__(self, cells: int = 64):
        self.cells = 1 << max(2, (cells - 1).bit_length())
        self.slots = np.zeros(self.cells * SLOTS, np.uint16).tolist()

    @classmethod
    def stored(cls, cells: int, slots: bytes) -> CuckooFilter:
        made = cls(0)
        made.cells, made.slots = cells, np.frombuffer(slots, np.uint16).tolist()
        return made

    def to_bytes(self) -> bytes:
        return np.asarray(self.slots, np.uint16).tobytes()

    @classmethod
    def holding(cls, digests: Iterable[bytes], cells: int = 4) -> CuckooFilter:
        """A filter of these digests, doubled until all find a place."""
        keys = list(digests)
        cells = max(cells, len(keys) // (SLOTS - 1) + 1)
        while True:
            made = cls(cells)
            if all(made.insert(d) for d in keys):
                return made
            cells = made.cells * 2

    @staticmethod
    def _finger(digest: bytes) -> int:
        return int.from_bytes(digest[8:10], "little") or 1

    def _first(self, digest: bytes) -> int:
        return int.from_bytes(digest[16:24], "little") & (self.cells - 1)

    def _other(self, cell: int, finger: int) -> int:
        return (cell ^ (finger * 0x5BD1E995)) & (self.cells - 1)

    def _cells(self, digest: bytes) -> tuple[int, int, int]:
        finger, cell = self._finger(digest), self._first(digest)
        return finger, cell, self._other(cell, finger)

    def __contains__(self, digest: bytes) -> bool:
        finger, a, b = self._cells(digest)
        s = self.slots
        return finger in s[a * SLOTS:a * SLOTS + SLOTS] or finger in s[b * SLOTS:b * SLOTS + SLOTS]

    def insert(self, digest: bytes) -> bool:
        finger, a, b = self._cells(digest)
        moved: list[tuple[int, int]] = []
        for cell in (a, b):
            for i in range(cell * SLOTS, cell * SLOTS + SLOTS):
                if not self.slots[i]:
                    self.slots[i] = finger
                    return True
        cell = b
        for k in range(KICKS):
            i = cell * SLOTS + k % SLOTS
            moved.append((i, self.slots[i]))
            self.slots[i], finger = finger, self.slots[i]
            cell = self._other(cell, finger)
            for j in range(cell * SLOTS, cell * SLOTS + SLOTS):
                if not self.slots[j]:
                    self.slots[j] = finger
                    return True
        for i, old in reversed(moved):  # give back what was moved: the filter stays as it was
            self.slots[i] = old
        return False

    def delete(self, digest: bytes) -> bool:
        finger, a, b = self._cells(digest)
        for cell in (a, b):
            for i in range(cell * SLOTS, cell * SLOTS + SLOTS):
                if self.slots[i] == finger:
                    self.slots[i] = 0
                    return True
        return False


class Bucket:
    """Live digests with a value each: a filter in front of the stored content."""

    def __init__(self, expected: int = 64):
        self.filter = CuckooFilter(expected // SLOTS + 1)
        self.content: dict[bytes, list] = {}
        self.resizes = 0

    def get(self, digest: bytes) -> list | None:
        return self.content.get(digest) if digest in self.filter else None

    def insert(self, digest: bytes, value: list) -> None:
        """Add a digest that is not there."""
        self.content[digest] = value
        if not self.filter.insert(digest):
            self._resize()

    def delete(self, digest: bytes) -> bool:
        if digest not in self.filter or self.content.pop(digest, None) is None:
            return False
        return self.filter.delete(digest)

    def _resize(self) -> None:
        self.resizes += 1
        self.filter = CuckooFilter.holding(self.content, self.filter.cells * 2)

    def fold(self, rows: Iterable[tuple[bytes, int, int, int | None, int | None]]) -> None:
        """Take in (digest, group size, length, id, row): sizes add up, the best row stays."""
        for digest, size, length, key, row in rows:
            live = self.get(digest)
            if live is None:
                self.insert(digest, [size, length, key, row])
                continue
            live[0] += size
            if (-length, key is None, key, row is None, row) < (-live[1], live[2] is None, live[2], live[3] is None, live[3]):
                live[1:] = length, key, row


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """doc_id, digest (binary) of the normalised text, length of the original in code points, and ``more``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("digest"),
                       F.length(text).cast("long").alias("length"), *more)


_ROW = "digest binary, size long, length long, doc_id long, row long"
_STORED = f"bucket long, {_ROW}, cells long, slots binary"
_VALUES = ["digest", "size", "length", "doc_id", "row"]


def _batch(content: dict[bytes, list]) -> pa.RecordBatch:
    values = list(zip(*content.values())) or [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(content), pa.binary()), *[pa.array(v, pa.int64()) for v in values]], _VALUES)


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bucket = Bucket(1024)
    for batch in batches:
        bucket.fold(zip(*[c.to_pylist() for c in batch.columns]))
        if len(bucket.content) >= FLUSH:
            yield _batch(bucket.content)
            bucket = Bucket(1024)
    yield _batch(bucket.content)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Number and rows, without the number, of each bucket; rows come sorted by bucket."""
    rows = (r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns]))
    for number, group in itertools.groupby(rows, key=lambda r: r[0]):
        yield number, (r[1:] for r in group)


def _filter_row(number: int, made: CuckooFilter | None, schema: pa.Schema) -> pa.RecordBatch:
    row = {"bucket": number, "cells": made and made.cells, "slots": made and made.to_bytes()}
    return pa.RecordBatch.from_pylist([{f: row.get(f) for f in schema.names}], schema)


_ARROW = pa.schema([("bucket", pa.int64()), ("digest", pa.binary()), ("size", pa.int64()), ("length", pa.int64()),
                    ("doc_id", pa.int64()), ("row", pa.int64()), ("cells", pa.int64()), ("slots", pa.binary())])


def _fill_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The content of each bucket, and a row without digest that carries its filter."""
    for number, rows in _by_bucket(batches):
        bucket = Bucket(1024)
        bucket.fold(rows)
        n = len(bucket.content)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, number)), *_batch(bucket.content).columns, pa.nulls(n, pa.int64()),
             pa.nulls(n, pa.binary())], schema=_ARROW)
        yield _filter_row(number, bucket.filter, _ARROW)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """New digests, one row each, and whether their bucket's stored filter holds them."""
    for number, rows in _by_bucket(batches):
        stored, bucket = None, Bucket(1024)
        for *row, cells, slots in rows:
            if row[0] is None:
                stored = CuckooFilter.stored(cells, slots)
            else:
                bucket.fold([tuple(row)])
        n = len(bucket.content)
        hits = [stored is not None and d in stored for d in bucket.content]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, number)), *_batch(bucket.content).columns, pa.array(hits, pa.bool_())],
            ["bucket", *_VALUES, "hit"])


_FILTER = pa.schema([("bucket", pa.int64()), ("cells", pa.int64()), ("slots", pa.binary())])


def _change_filters(batches: Iterator[pa.RecordBatch], insert: bool) -> Iterator[pa.RecordBatch]:
    """Each bucket's filter with its digests put in or taken out; without slots if one found no place."""
    for number, rows in _by_bucket(batches):
        made = CuckooFilter()
        for digest, cells, slots in rows:
            if digest is None:
                made = CuckooFilter.stored(cells, slots)
            elif made is not None and not (made.insert(digest) if insert else made.delete(digest)):
                made = None
        yield _filter_row(number, made, _FILTER)


def _refill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, rows in _by_bucket(batches):
        yield _filter_row(number, CuckooFilter.holding(d for d, in rows), _FILTER)


def _best(prefix: str = "") -> Column:
    """What decides which row of a group stays; the least does."""
    length, key, row = (F.col(prefix + c) for c in ("length", "doc_id", "row"))
    return F.struct((-length).alias("length"), key.isNull().alias("no_id"), key.alias("doc_id"),
                    row.isNull().alias("no_row"), row.alias("row"))


def _dealt(df: DataFrame, *first: str) -> DataFrame:
    return df.repartition("bucket").sortWithinPartitions("bucket", *first)


@dataclass(frozen=True)
class LiveIndex:
    """Live digests in buckets: ``content`` (bucket, digest, size, length, doc_id, row) and ``filters``
    (bucket, cells, slots), both staged. A change gives a new index and leaves this one as it is."""

    content: DataFrame
    filters: DataFrame
    buckets: int

    @staticmethod
    def _numbered(rows: DataFrame, buckets: int) -> DataFrame:
        return rows.select(F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"), *_VALUES)

    @classmethod
    def build(cls, rows: DataFrame) -> LiveIndex:
        """The index of (doc_id, digest, length); ``row``, if there, numbers the rows."""
        return cls.of(_combined(rows))

    @classmethod
    def of(cls, combined: DataFrame) -> LiveIndex:
        """The index of (digest, size, length, doc_id, row), which may have several rows of a digest."""
        spark = combined.sparkSession
        combined = stage(combined.select(*_VALUES), "digest-rows")
        least = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(least, -(-combined.count() // BUCKET_ROWS))
        both = stage(_dealt(cls._numbered(combined, buckets)).mapInArrow(_fill_buckets, _STORED), "digest-index")
        return cls(both.filter("digest IS NOT NULL").select("bucket", *_VALUES),
                   both.filter("digest IS NULL").select("bucket", "cells", "slots"), buckets)

    def _probed(self, rows: DataFrame) -> DataFrame:
        both = self._numbered(rows, self.buckets).unionByName(self.filters, allowMissingColumns=True)
        first = both.select("bucket", *_VALUES, "cells", "slots", F.col("digest").isNotNull().alias("new"))
        return stage(_dealt(first, "new").drop("new").mapInArrow(_probe, f"bucket long, {_ROW}, hit boolean"), "probed")

    def _verified(self, probed: DataFrame) -> DataFrame:
        """The hits, with ``live``: whether the content has them. A filter may hold what it was never given."""
        live = self.content.select("digest", F.lit(True).alias("live"))
        return stage(probed.filter("hit").drop("hit").join(live, "digest", "left"), "verified")

    def _changed(self, digests: DataFrame, content: DataFrame, insert: bool) -> DataFrame:
        both = self.filters.unionByName(digests.select("bucket", "digest"), allowMissingColumns=True)
        first = both.select("bucket", "digest", "cells", "slots", F.col("digest").isNotNull().alias("new"))
        made = stage(_dealt(first, "new").drop("new").mapInArrow(
            lambda b: _change_filters(b, insert), "bucket long, cells long, slots binary"), "filters")
        full = content.select("bucket", "digest").join(made.filter("slots IS NULL"), "bucket", "left_semi")
        again = _dealt(full).mapInArrow(_refill, "bucket long, cells long, slots binary")
        return stage(made.filter("slots IS NOT NULL").unionByName(again), "filters")

    def insert(self, rows: DataFrame) -> LiveIndex:
        """The index after the rows (doc_id, digest, length) came in."""
        return self._insert(_combined(rows))

    def _insert(self, combined: DataFrame) -> LiveIndex:
        probed = self._probed(combined)
        hits = self._verified(probed)
        fresh = probed.filter("NOT hit").drop("hit").unionByName(hits.filter("live IS NULL").drop("live"))
        more = hits.filter("live").select("digest", F.col("size").alias("more"), _best().alias("other"))
        grown = self.content.join(more, "digest", "left").withColumn("best", F.least(_best(), F.col("other"))).select(
            "bucket", "digest", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"),
            (-F.col("best.length")).alias("length"), F.col("best.doc_id").alias("doc_id"), F.col("best.row").alias("row"))
        content = stage(grown.unionByName(fresh), "digest-content")
        return LiveIndex(content, self._changed(fresh, content, True), self.buckets)

    def delete(self, gone: DataFrame, column: str = "digest") -> LiveIndex:
        """The index without the digests of ``gone``; those it does not hold change nothing."""
        none = [F.lit(0).cast("long").alias(c) for c in _VALUES[1:]]
        digests = gone.select(F.col(column).alias("digest"), *none).filter("digest IS NOT NULL")
        leaving = self._verified(self._probed(digests)).filter("live").select("bucket", "digest")
        content = stage(self.content.join(leaving.select("digest"), "digest", "left_anti").select(
            "bucket", *_VALUES), "digest-content")
        return LiveIndex(content, self._changed(leaving, content, False), self.buckets)


def _combined(rows: DataFrame) -> DataFrame:
    ship(rows.sparkSession)
    row = F.col("row") if "row" in rows.columns else F.lit(None)
    single = rows.select("digest", F.lit(1).cast("long").alias("size"), "length",
                         F.col("doc_id").cast("long").alias("doc_id"), row.cast("long").alias("row"))
    return single.mapInArrow(_combine, _ROW)


def build_index(rows: DataFrame) -> DataFrame:
    """The content of the index of (doc_id, digest, length): one row per live digest.

    Columns: digest, size of its group, length, doc_id and number of the row that stays; the
    number is null unless ``rows`` has the column ``row``.
    """
    return LiveIndex.build(rows).content.select(*_VALUES)


def insert(index: DataFrame, rows: DataFrame) -> DataFrame:
    """Content after the rows (doc_id, digest, length) came in, for content kept without its filters."""
    ship(rows.sparkSession)
    return LiveIndex.of(index).insert(rows).content.select(*_VALUES)


def delete(index: DataFrame, gone: DataFrame, column: str = "digest") -> DataFrame:
    """Content without the digests of ``gone``, for content kept without its filters."""
    ship(index.sparkSession)
    return LiveIndex.of(index).delete(gone, column).content.select(*_VALUES)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stage(digests(docs, id_col, text_col), "digests")
    index = build_index(rows).select(
        "digest", F.col("size").alias("group_size"), F.col("doc_id").alias("keep_id"))
    return rows.join(index, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def unique_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one row of each group, with all their columns."""
    rows = numbered(docs)
    index = build_index(digests(rows, id_col, text_col, F.col(ROW).alias("row")))
    return chosen(rows, index.select("row"))
