"""Repeated word windows by recompression: the first occurrence stays.

Every window of 20 words has an anchor: of the symbols of two rounds that depend on its
words alone, the one with the least hash of its name and its words (a window without one
is its own). Equal windows have equal anchors at equal places, so windows whose anchor's
name stands in one place only are unique and go no further.

What is left is joined on in Spark rounds (``symbol_rounds``). Each takes several rounds of
runs and pairs inside the tasks, then counts the names over the corpus. A name that stands
in several places is a repeat as long as the symbol, so all windows inside any but its
first place go at once. Symbols that stand once cannot be in a longer repeat: they are cut
out, and the stretches between them go into the next round, until nothing is shared.

Windows that no such symbol holds lie at the edges of repeats or across two symbols. They
are compared by anchor, and then one by one, by the sequence of the largest symbols inside
them (``Symbols.names_of``), which is the same for equal words and for no others.

A text's words are runs of visible characters, unchanged. Null text has none. Of copies
of a text all but those with the smallest id lose every word that a window covers; rows
that repeat that id are the same document and share its result. A null id comes after all
others. An empty table gives no rows; other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hemline.llm.common import Block, blocks, mix, prefix_hash, ship, span_hash, stage
from hemline.llm.repeats import (anchor_rows, contexts, keyed, owners, shared_anchors, shared_rows,
                                 with_texts)
from hemline.llm.symbols import Symbols
from hemline.sources.staging import Scope

WINDOW = 20
#: Rounds of runs and pairs that anchors come from.
ROUNDS = 2
#: Rounds before symbols are first counted over the corpus: they hold about a window then.
FIRST = 10
#: Rounds between two counts; each makes of four symbols about three.
STEP = 8


def least_in(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Place of the least value (leftmost of equals) in each [lo, hi); these are not empty."""
    table, width = [np.arange(len(values))], 1
    most = int((hi - lo).max(initial=1))
    while 2 * width <= most:
        t = table[-1]
        a, b = t[:-width], t[width:]
        table.append(np.concatenate([np.where(values[b] < values[a], b, a), t[-width:]]))
        width *= 2
    level = np.floor(np.log2(np.maximum(hi - lo, 1))).astype(np.int64)
    stack = np.stack(table)
    a, b = stack[level, lo], stack[level, hi - (1 << level)]
    return np.where(values[b] < values[a], b, a)


def word_hashes(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    start, end, before = block.words()
    return span_hash(prefix_hash(block.data), start, end), start, end, before


def window_anchors(words: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, ...]:
    """fp, ctx, row, first window and number of windows of every anchor."""
    n = np.diff(before)
    count = np.maximum(n - WINDOW + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    if not len(row):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    first = before[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    symbols = Symbols(words, np.repeat(np.arange(len(n)), n))
    names, start, low, high = symbols.safe(ROUNDS)
    # within a row low and high never fall; far edges are cut so that this holds over the block
    own = np.searchsorted(before, start, side="right") - 1
    low = np.maximum(low, before[own] - 1)
    high = np.minimum(high, before[own + 1] + 1)
    low, high = np.maximum.accumulate(low), np.maximum.accumulate(high)
    lo = np.searchsorted(low, first, side="left")
    hi = np.searchsorted(high, first + WINDOW, side="right")
    has = hi > lo
    anchor = np.full(len(row), -1)
    prefix = prefix_hash(words)
    # a safe symbol's name goes with all the words it depends on, which the window holds
    with np.errstate(over="ignore"):
        names = mix(names + span_hash(prefix, np.maximum(low, 0), np.clip(high, 0, len(words))))
    if has.any():
        anchor[has] = least_in(names, lo[has], hi[has])
    # consecutive windows of one anchor are one row; windows without one stand alone
    head = np.ones(len(row), bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (anchor[1:] < 0) | (row[1:] != row[:-1])
    at = np.flatnonzero(head)
    windows = np.diff(np.append(at, len(row)))
    begin, mine = first[at], anchor[at]
    ctx = symbols.names_of(begin, begin + windows - 1 + WINDOW)
    with np.errstate(over="ignore"):
        place = np.where(mine >= 0, start[mine] - begin, 0).astype(np.uint64)
        ctx = mix(ctx + place * np.uint64(0x8EBC6AF09C88C6E3))
    fp = np.where(mine >= 0, names[mine], ctx)
    return fp, ctx, row[at], begin - before[row[at]], windows


def _anchors(block: Block, keys: np.ndarray) -> pa.RecordBatch:
    words, _, _, before = word_hashes(block)
    return anchor_rows(*window_anchors(words, before), keys, both=False)


def _ranges(block: Block, column: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and number of windows of the (start, n) lists in a column."""
    lists = block.rows.column(column)
    lists = lists.fill_null([]) if lists.null_count else lists
    flat = lists.flatten()
    row = np.repeat(np.arange(len(block)), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
    return row, flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, owner, key, start) of every window in the ranges of (key, owner, ranges, text)."""
    for block in blocks(batches):
        words, _, _, before = word_hashes(block)
        row, start, n = _ranges(block, 2)
        part = np.repeat(np.arange(len(row)), n)
        at = start[part] + np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
        place = before[row[part]] + at
        symbols = Symbols(words, np.repeat(np.arange(len(block)), np.diff(before)))
        name = symbols.names_of(place, place + WINDOW).view(np.int64)
        pick = pa.array(row[part])
        yield pa.RecordBatch.from_arrays(
            [pa.array(name), block.rows.column(1).take(pick), block.rows.column(0).take(pick),
             pa.array(at.astype(np.int32))], ["name", "owner", "key", "start"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The result of every text, for its owner and for its copies."""
    empty = hashlib.sha256(b"").hexdigest()
    for block in blocks(batches):
        start, end, before = block.words()
        row, first, n = _ranges(block, 2)
        change = np.zeros(len(start) + 1, np.int64)
        np.add.at(change, before[row] + first, 1)
        np.add.at(change, before[row] + first + n - 1 + WINDOW, -1)
        gone = np.cumsum(change)[:-1] > 0
        n_words = np.diff(before)
        removed = np.diff(np.append(0, np.cumsum(gone))[before])

        def digests(keep: np.ndarray) -> list[str]:
            size = np.where(keep, end - start + 1, 0)
            to = np.cumsum(size) - size
            out = np.full(int(size.sum()), 0x20, np.uint8)
            length = np.where(keep, end - start, 0)
            k = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
            out[np.repeat(to, length) + k] = block.data[np.repeat(start, length) + k]
            at = np.append(to, len(out))[before]
            raw = out.tobytes()
            return [hashlib.sha256(raw[a:max(a, b - 1)]).hexdigest() for a, b in zip(at[:-1], at[1:])]

        mine = digests(~gone)
        # only texts shorter than a window keep anything in their copies
        copies = [empty if k >= WINDOW else m for k, m in zip(n_words, mine)]
        yield pa.RecordBatch.from_arrays(
            [block.rows.column(0), block.rows.column(1), pa.array(n_words), pa.array(removed), pa.array(mine),
             pa.array(np.where(n_words >= WINDOW, n_words, 0)), pa.array(copies)],
            ["key", "owner", "n_words", "removed", "kept", "copy_removed", "copy_kept"])


def _symbol_rows(key: pa.Array, owner: pa.Array, row: np.ndarray, start: np.ndarray, size: np.ndarray,
                 name: np.ndarray) -> pa.RecordBatch:
    pick = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [key.take(pick), owner.take(pick), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)),
         pa.array(name.view(np.int64))], _SYMBOL_NAMES)


def _first_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The symbols of (key, owner, ranges, text) whose words all lie in windows of the ranges."""
    for block in blocks(batches):
        words, _, _, before = word_hashes(block)
        if not len(words):
            continue
        row, first, n = _ranges(block, 2)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, before[row] + first, 1)
        np.add.at(change, before[row] + first + n - 1 + WINDOW, -1)
        covered = np.append(0, np.cumsum(np.cumsum(change)[:-1] > 0))
        own = np.repeat(np.arange(len(block)), np.diff(before))
        name, start = Symbols(words, own).after(FIRST)
        end = np.append(start[1:], len(words))
        live = np.flatnonzero(covered[end] - covered[start] == end - start)
        text = own[start[live]]
        yield _symbol_rows(block.rows.column(0), block.rows.column(1), text, start[live] - before[text],
                           end[live] - start[live], name[live])


def _next_symbols(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    """The symbols of (key, owner, symbols) after more rounds in each stretch of two or more."""
    for batch in batches:
        lists = batch.column(2)
        flat = lists.flatten()
        start, size, name = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        text = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(lists).to_numpy())
        opens = np.ones(len(start), bool)
        opens[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1] + size[:-1])
        alone = opens & np.append(opens[1:], True)
        some = np.flatnonzero(~alone)
        if not len(some):
            continue
        stretch, end = np.cumsum(opens)[some], start[some].astype(np.int64) + size[some]
        made, head = Symbols(name[some].view(np.uint64), stretch, level).after(STEP)
        to = end[np.append(head[1:], len(some)) - 1]
        begin = start[some][head]
        yield _symbol_rows(batch.column(0), batch.column(1), text[some][head], begin, to - begin, made)


_SYMBOLS = "key long, owner long, start int, size int, name long"
_SYMBOL_NAMES = ["key", "owner", "start", "size", "name"]
_ORDER = ["no_owner", "owner", "key", "start"]


def symbol_rounds(texts: DataFrame, live: DataFrame) -> DataFrame:
    """(key, start, n): windows inside a symbol that also stands earlier.

    ``live`` (key, owner, ranges) lists the windows whose anchors are shared.
    """
    symbols = stage(with_texts(texts, live).mapInArrow(_first_symbols, _SYMBOLS), "symbols")
    level, found = FIRST, []
    while True:
        ordered = symbols.withColumn("no_owner", F.col("owner").isNull())
        named = ordered.groupBy("name").agg(F.count("*").alias("places"), F.min(F.struct(*_ORDER)).alias("head"))
        shared = ordered.join(named.filter("places > 1"), "name").withColumn(
            "first", F.struct(*_ORDER) == F.col("head"))
        shared = stage(shared.select(*_SYMBOL_NAMES, "first"), "shared-symbols")
        found.append(shared.filter(~F.col("first") & (F.col("size") >= WINDOW)).select(
            "key", "start", (F.col("size") - WINDOW + 1).alias("n")))
        # repeated rows of a document give its symbols again: one of each
        stretches = shared.groupBy("key", "owner").agg(
            F.sort_array(F.collect_set(F.struct("start", "size", "name"))).alias("symbols"))
        symbols = stage(stretches.mapInArrow(lambda b, at=level: _next_symbols(b, at), _SYMBOLS), "symbols")
        level += STEP
        if symbols.isEmpty():
            break
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return stage(every, "repeated-symbols")


def _outside(rows: DataFrame, covered: DataFrame) -> DataFrame:
    """The rows (key, start, n, ...) of which not all windows lie in one covered range of their text."""
    end = F.col("start") + F.col("n")
    lists = covered.select("key", "start", "n", F.lit(True).alias("cover"))
    both = rows.withColumn("cover", F.lit(False)).unionByName(lists, allowMissingColumns=True)
    so_far = Window.partitionBy("key").orderBy("start", F.desc("cover")).rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("cover"), end)).over(so_far)
    return both.withColumn("reach", reach).filter(~F.col("cover") & (F.coalesce("reach", F.lit(0)) < end)).select(*rows.columns)


def repeated_ranges(texts: DataFrame, own: DataFrame) -> DataFrame:
    """(key, ranges): windows, as (start, n), of each text that also start earlier."""
    with Scope(texts.sparkSession) as scope:
        rows = shared_anchors(texts, _anchors)
        live = rows.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))
        inside = symbol_rounds(texts, own.select("key", "owner").join(live, "key"))
        ordered = _outside(rows.filter("NOT sure"), inside).join(own.select("key", "owner"), "key").withColumn(
            "no_owner", F.col("owner").isNull())
        marked = stage(contexts(ordered, _ORDER).select("key", "owner", "start", "n", "first", "names"), "anchors")
        later = marked.filter("NOT first").select("key", "start", "n")
        edges = marked.filter("first AND names > 1").groupBy("key", "owner").agg(
            F.collect_list(F.struct("start", "n")).alias("ranges"))
        edges = stage(edges, "edge-windows")
        windows = with_texts(texts, edges).select("key", "owner", "ranges", "text").mapInArrow(
            _windows, "name long, owner long, key long, start int").withColumn("no_owner", F.col("owner").isNull())
        dealt = windows.select("name", "no_owner", "owner", "key", "start").withColumn(
            "owner", F.coalesce("owner", F.lit(0))).repartition("name").sortWithinPartitions(
            "name", "no_owner", "owner", "key", "start")
        single = dealt.mapInArrow(lambda b: shared_rows(b, 0, [0, 3, 4], skip_first=True),
                                  "name long, no_owner boolean, owner long, key long, start int")
        single = single.select("key", "start", F.lit(1).alias("n"))
        sure = rows.filter("sure").select("key", "start", "n")
        every = sure.unionByName(inside).unionByName(later).unionByName(single)
        return scope.keep(stage(every.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("ranges")), "repeats"))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    ship(docs.sparkSession)
    texts = keyed(docs, id_col, text_col)
    nodes = stage(texts.select("doc_id", "key"), "nodes")
    own = stage(owners(nodes), "owners")
    ranges = repeated_ranges(texts, own)
    wanted = own.select("key", "owner").join(ranges, "key", "left")
    result = with_texts(texts, wanted).select("key", "owner", "ranges", "text").mapInArrow(
        _kept, "key long, owner long, n_words long, removed long, kept string, copy_removed long, copy_kept string")
    joined = nodes.join(result.dropDuplicates(["key"]), "key")
    mine = F.col("doc_id").eqNullSafe(F.col("owner"))
    return joined.select("doc_id", "n_words", F.when(mine, F.col("removed")).otherwise(F.col("copy_removed")).alias("n_removed"),
                         F.when(mine, F.col("kept")).otherwise(F.col("copy_kept")).alias("kept_sha256"))
