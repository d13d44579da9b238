"""Repeated byte strings by longest-previous-factor arrays on a sparse suffix order.

A window is ``length`` bytes. Its anchor is the place of its least hashed ``GRAM`` bytes,
so equal windows have equal anchors. Whole contexts of anchors are compared first; what is
left is a sparse set of suffixes, the windows at the edges of copies. Those of one anchor
name go to one task, which puts them in suffix order by prefix doubling up to ``length``
bytes, ties by position. There the nearest suffix with a smaller position and one with a
larger position are its neighbours of equal rank: they give the longest previous and next
factors, cut at ``length``. A suffix whose longest previous factor has ``length`` bytes is
a later copy; with ``keep="first"`` these go and the first stays, with ``keep="none"``
every member of a repeat goes.

A name with more contexts than fit ``CHUNK`` bytes is not put in one task's suffix order:
its windows are named by hash and meet by name, over all tasks, with the same result.

Null text counts as empty. Rows of one text are copies of each other. Matches never cross
documents. Texts shorter than ``length`` bytes keep all. With ``keep="first"`` the first
is that of the smallest id (null last), and rows that repeat this id and text count as the
same document. An empty table gives no rows; other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hemline.llm.common import Block, blocks, mix, prefix_hash, ship, span_hash, stage
from hemline.llm.recompression import _ranges
from hemline.llm.repeats import (anchor_rows, contexts, keyed, owners, shared_anchors, shared_rows,
                                 with_texts)

LENGTH = 400
GRAM = 48
#: Bytes of contexts in one suffix order; its arrays take about sixty times that.
CHUNK = 5 << 20
#: Smaller names gather up to this size.
GATHER = 1 << 20


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value, leftmost of equals, in each window of ``width`` values."""
    n = len(values) - width + 1
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:len(at) - step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        have += step
    return at[:n]


def window_anchors(block: Block, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """fp, ctx, row, first window and number of windows of every anchor."""
    size = np.diff(block.at)
    count = np.maximum(size - length + 1, 0)
    if not count.any():
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    prefix = prefix_hash(block.data)
    place = np.arange(len(block.data) - GRAM + 1)
    grams = span_hash(prefix, place, place + GRAM)
    # 32 bits of order are enough to choose by; the name is the whole hash
    least = sliding_least((mix(grams) >> np.uint64(32)).astype(np.uint32), length - GRAM + 1)
    row = np.repeat(np.arange(len(size)), count)
    first = block.at[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    anchor = least[first]
    head = np.ones(len(row), bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(head)
    windows = np.diff(np.append(at, len(row)))
    begin, mine = first[at], anchor[at]
    ctx = span_hash(prefix, begin, begin + windows - 1 + length)
    with np.errstate(over="ignore"):
        ctx = mix(ctx + (mine - begin).astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))
    return grams[mine], ctx, row[at], begin - block.at[row[at]], windows


def suffix_ranks(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Ranks of the ``length``-byte prefixes of suffixes, equal for equal prefixes."""
    padded = np.append(data, np.zeros(length, np.uint8))
    n = len(data)
    rank = np.zeros(n, np.uint64)
    for k in range(8):
        rank = (rank << np.uint64(8)) | padded[k:k + n]
    rank = np.unique(rank, return_inverse=True)[1].astype(np.uint32)
    have = 8
    while have < length:
        step = min(have, length - have)
        final = have + step == length
        at = starts if final else np.arange(n)
        low = np.zeros(n + length, np.uint32)
        low[:n] = rank
        rank = np.unique((low[at].astype(np.uint64) << np.uint64(32)) | low[at + step],
                         return_inverse=True)[1].astype(np.uint32)
        have += step
    return rank


def factors(rank: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix has a previous and a next factor of full length.

    ``order`` is each suffix's position in the order of all texts. In suffix order with
    ties by position, the previous smaller and next larger positions of equal rank are the
    rows above and below.
    """
    by = np.lexsort((order, rank))
    same = rank[by[1:]] == rank[by[:-1]]
    earlier, later = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    earlier[by[1:]] = same
    later[by[:-1]] = same
    return earlier, later


def _edge_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(fp, key, start, n, bytes): the contexts of edge anchors, cut from their texts."""
    for block in blocks(batches):
        lists = block.rows.column(2)
        flat = lists.flatten()
        row = np.repeat(np.arange(len(block)), pa.compute.list_value_length(lists).to_numpy())
        start, n, fp = (flat.field(i).to_numpy() for i in range(3))
        begin = block.at[row] + start
        raw = block.data.tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array(fp), block.rows.column(0).take(pa.array(row)),
             block.rows.column(1).take(pa.array(row)), pa.array(start), pa.array(n),
             pa.array([raw[a:a + k - 1 + length] for a, k in zip(begin.tolist(), n.tolist())], pa.binary())],
            ["fp", "key", "owner", "start", "n", "bytes"])


_MARKS = "key long, owner long, start int, n int, name long"


def _marks(rows: list[tuple], length: int, first_stays: bool) -> pa.RecordBatch:
    """Repeated windows of the contexts of some names, by their suffix order."""
    fp, key, owner, start, n, raw = (list(x) for x in zip(*rows))
    data = np.frombuffer(b"".join(raw), np.uint8)
    n, start = np.asarray(n, np.int64), np.asarray(start, np.int64)
    sizes = np.asarray([len(x) for x in raw], np.int64)
    base = np.cumsum(sizes) - sizes
    part = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
    rank = suffix_ranks(data, base[part] + inside, length)
    # position: owner (null last), then key, then place in the text
    texts = sorted({(o is None, o or 0, k) for o, k in zip(owner, key)})
    number = {t: i for i, t in enumerate(texts)}
    text = np.asarray([number[(o is None, o or 0, k)] for o, k in zip(owner, key)], np.int64)
    earlier, later = factors(rank, (text[part] << 36) + start[part] + inside)
    out = np.flatnonzero(earlier if first_stays else earlier | later)
    # consecutive windows of a row become one range
    heads = np.ones(len(out), bool)
    heads[1:] = (out[1:] != out[:-1] + 1) | (part[out[1:]] != part[out[:-1]])
    at = np.flatnonzero(heads)
    length_ = np.diff(np.append(at, len(out)))
    mine = part[out[at]]
    return pa.RecordBatch.from_arrays(
        [pa.array([key[i] for i in mine], pa.int64()), pa.array([owner[i] for i in mine], pa.int64()),
         pa.array((start[mine] + inside[out[at]]).astype(np.int32)), pa.array(length_.astype(np.int32)),
         pa.nulls(len(at), pa.int64())], ["key", "owner", "start", "n", "name"])


def _named(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Every window of the rows with its name, to meet others elsewhere."""
    _, key, owner, start, n, raw = (list(x) for x in zip(*rows))
    n, start = np.asarray(n, np.int64), np.asarray(start, np.int64)
    sizes = np.asarray([len(x) for x in raw], np.int64)
    base = np.cumsum(sizes) - sizes
    part = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
    at = base[part] + inside
    name = span_hash(prefix_hash(np.frombuffer(b"".join(raw), np.uint8)), at, at + length)
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()).take(pa.array(part)), pa.array(owner, pa.int64()).take(pa.array(part)),
         pa.array((start[part] + inside).astype(np.int32)), pa.array(np.ones(len(part), np.int32)),
         pa.array(name.view(np.int64))], ["key", "owner", "start", "n", "name"])


def _edges(batches: Iterator[pa.RecordBatch], length: int, first_stays: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by name. Whole names gather to one suffix order; a name over CHUNK is named out."""
    ready: list[tuple] = []
    group: list[tuple] = []
    ready_bytes = group_bytes = 0
    large = False
    for batch in batches:
        for r in zip(*[c.to_pylist() for c in batch.columns]):
            if group and r[0] != group[0][0]:
                if ready and ready_bytes + group_bytes > GATHER:
                    yield _marks(ready, length, first_stays)
                    ready, ready_bytes = [], 0
                if large:
                    yield _named(group, length)
                else:
                    ready += group
                    ready_bytes += group_bytes
                group, group_bytes, large = [], 0, False
            elif group and r[1:4] == group[-1][1:4]:
                continue
            group.append(r)
            group_bytes += len(r[5])
            if group_bytes > CHUNK:
                large = True
                yield _named(group[:-1], length) if len(group) > 1 else _named(group, length)
                group, group_bytes = (group[-1:], len(r[5])) if len(group) > 1 else ([], 0)
    if ready and ready_bytes + group_bytes > GATHER:
        yield _marks(ready, length, first_stays)
        ready = []
    if group and large:
        yield _named(group, length)
    elif group:
        ready += group
    if ready:
        yield _marks(ready, length, first_stays)


def repeated_ranges(texts: DataFrame, own: DataFrame, length: int = LENGTH, keep: str = "none") -> DataFrame:
    """(key, ranges): windows, as (start, n), that repeat (all of them, or all but the first)."""
    first_stays = keep == "first"

    def anchors(block: Block, keys: np.ndarray) -> pa.RecordBatch:
        return anchor_rows(*window_anchors(block, length), keys, both=not first_stays)

    rows = shared_anchors(texts, anchors)
    ordered = rows.join(own.select("key", "owner"), "key").withColumn("no_owner", F.col("owner").isNull())
    marked = stage(contexts(ordered, ["no_owner", "owner", "key", "start"]).select(
        "fp", "key", "owner", "start", "n", "count", "first", "names"), "anchors")
    whole = marked.filter("NOT first" if first_stays else "count > 1").select("key", "start", "n")
    edges = stage(marked.filter("first AND names > 1").groupBy("key", "owner").agg(
        F.collect_list(F.struct("start", "n", "fp")).alias("ranges")), "edge-anchors")
    cut = with_texts(texts, edges).select("key", "owner", "ranges", "text").mapInArrow(
        lambda b: _edge_rows(b, length), "fp long, key long, owner long, start int, n int, bytes binary")
    dealt = cut.repartition("fp").sortWithinPartitions("fp", "key", "start")
    found = stage(dealt.mapInArrow(lambda b: _edges(b, length, first_stays), _MARKS), "suffix-marks")
    named = found.filter("name IS NOT NULL").select(
        "name", F.col("owner").isNull().alias("no_owner"), F.coalesce("owner", F.lit(0)).alias("owner"), "key", "start")
    met = named.repartition("name").sortWithinPartitions("name", "no_owner", "owner", "key", "start").mapInArrow(
        lambda b: shared_rows(b, 0, [0, 3, 4], skip_first=first_stays),
        "name long, no_owner boolean, owner long, key long, start int")
    every = rows.filter("sure").select("key", "start", "n").unionByName(whole).unionByName(
        found.filter("name IS NULL").select("key", "start", "n")).unionByName(
        met.select("key", "start", F.lit(1).alias("n")))
    return stage(every.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("ranges")), "repeats")


def _kept(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        row, start, n = _ranges(block, 2)
        change = np.zeros(len(block.data) + 1, np.int64)
        np.add.at(change, block.at[row] + start, 1)
        np.add.at(change, block.at[row] + start + n - 1 + length, -1)
        gone = np.cumsum(change)[:-1] > 0
        size = np.diff(block.at)
        removed = np.diff(np.append(0, np.cumsum(gone))[block.at])
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        edge = block.at[:-1][size > 0]
        opens[edge] = gone[edge]
        spans = np.diff(np.append(0, np.cumsum(opens))[block.at])
        kept = [hashlib.sha256(block.data[a:b][~gone[a:b]].tobytes()).hexdigest()
                for a, b in zip(block.at[:-1], block.at[1:])]
        yield pa.RecordBatch.from_arrays(
            [block.rows.column(0), block.rows.column(1), pa.array(size), pa.array(removed), pa.array(spans),
             pa.array(kept)], ["key", "owner", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 keep: str = "none") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    ship(docs.sparkSession)
    texts = keyed(docs, id_col, text_col)
    nodes = stage(texts.select("doc_id", "key"), "nodes")
    own = stage(owners(nodes), "owners")
    ranges = repeated_ranges(texts, own, length, keep)
    wanted = own.select("key", "owner").join(ranges, "key", "left")
    result = with_texts(texts, wanted).select("key", "owner", "ranges", "text").mapInArrow(
        lambda b: _kept(b, length),
        "key long, owner long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    joined = nodes.join(result.dropDuplicates(["key"]).join(own.select("key", "copies"), "key"), "key")
    # a text long enough that stands in several rows is a repeat from end to end
    again = F.col("n_bytes") >= length
    again &= ~F.col("doc_id").eqNullSafe(F.col("owner")) if keep == "first" else F.col("copies") > 1
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        "doc_id", "n_bytes", F.when(again, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(again, 1).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(again, empty).otherwise(F.col("kept_sha256")).alias("kept_sha256"))
