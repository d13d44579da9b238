"""What the two operators on repeated passages share: anchors, contexts, and where they meet.

Every window of a text belongs to one anchor, chosen by the window's content alone, so
equal windows have equal anchors at equal places. An anchor's consecutive windows are one
row: its name, a hash of all they cover (their context), the text's key, the first window
and the number of windows. Rows of one context repeat as a whole. Only where one name has
several contexts do single windows have to be compared, and then only those of one row of
each context.

Texts are told apart by a 64-bit hash, the key. Copies of a text are one text; its owner
is the smallest id among them (null last), and texts are ordered by owner, then key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hemline.llm.common import Block, blocks, ship, stage

ROWS = "fp long, ctx long, key long, start int, n int, sure boolean"
_NAMES = ["fp", "ctx", "key", "start", "n", "sure"]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, text), null text as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"),
                       text.alias("text"))


def owners(nodes: DataFrame) -> DataFrame:
    """(key, owner, copies) from (doc_id, key)."""
    return nodes.groupBy("key").agg(F.min("doc_id").alias("owner"), F.count("*").alias("copies"))


def with_texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (key, owner, ...) with the text of each owner."""
    right = wanted.select(F.col("key").alias("__key"), *[c for c in wanted.columns if c != "key"])
    both = texts.join(right, (texts["key"] == F.col("__key")) & texts["doc_id"].eqNullSafe(F.col("owner")))
    return both.select("key", "owner", *[c for c in wanted.columns if c not in ("key", "owner")], "text")


def anchor_rows(fp: np.ndarray, ctx: np.ndarray, row: np.ndarray, start: np.ndarray, n: np.ndarray,
                keys: np.ndarray, both: bool) -> pa.RecordBatch:
    """Rows of a block. Of equal contexts in one text the first is sent on; the others are sure.

    With ``both`` the first of several is sure as well, besides being sent on.
    """
    order = np.lexsort((start, ctx, fp, row))
    fp, ctx, row, start, n = fp[order], ctx[order], row[order], start[order], n[order]
    again = np.zeros(len(fp), bool)
    again[1:] = (fp[1:] == fp[:-1]) & (ctx[1:] == ctx[:-1]) & (row[1:] == row[:-1])
    sure = again.copy()
    if both:
        sure[:-1] |= again[1:]
    # sure rows need no name; those that follow each other become one
    s = np.flatnonzero(sure)
    s = s[np.lexsort((start[s], row[s]))]
    joins = np.zeros(len(s), bool)
    joins[1:] = (row[s[1:]] == row[s[:-1]]) & (start[s[1:]] == start[s[:-1]] + n[s[:-1]])
    heads = np.flatnonzero(~joins)
    total = np.add.reduceat(n[s], heads) if len(heads) else np.zeros(0, n.dtype)
    s, keep = s[heads], np.flatnonzero(~again)
    pick = np.concatenate([keep, s])
    return pa.RecordBatch.from_arrays(
        [pa.array(fp[pick].view(np.int64)), pa.array(ctx[pick].view(np.int64)), pa.array(keys[row[pick]]),
         pa.array(start[pick].astype(np.int32)), pa.array(np.concatenate([n[keep], total]).astype(np.int32)),
         pa.array(np.arange(len(pick)) >= len(keep))], _NAMES)


def shared_rows(batches: Iterator[pa.RecordBatch], group: int, identity: list[int],
                skip_first: bool = False, sure: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by group and identity, of groups with two different rows or more.

    ``skip_first`` leaves out the first row of each group. Rows marked in column ``sure``
    pass by. Groups may span batches; only the last row is held.
    """
    last: tuple | None = None
    done = False
    for batch in batches:
        if not batch.num_rows:
            continue
        if sure is not None:
            mark = batch.column(sure)
            passed = batch.filter(mark)
            if passed.num_rows:
                yield passed
            batch = batch.filter(pa.compute.invert(mark))
            if not batch.num_rows:
                continue
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        fresh = np.ones(len(cols[0]), bool)
        same = np.ones(len(fresh) - 1, bool)
        for i in identity:
            same &= cols[i][1:] == cols[i][:-1]
        fresh[1:] = ~same
        if last is not None and all(cols[i][0] == last[i] for i in identity):
            fresh[0] = False
        cols = [c[fresh] for c in cols]
        if not len(cols[0]):
            continue
        opens = np.ones(len(cols[0]), bool)
        opens[1:] = cols[group][1:] != cols[group][:-1]
        if last is not None and cols[group][0] == last[group]:
            opens[0] = False
        held = []
        if skip_first:
            out = ~opens
        else:
            out = ~opens | np.append(~opens[1:], False)
            if not opens[0] and not done:
                held = [last]
        done = bool(out[-1])
        last = tuple(c[-1] for c in cols)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.array([h[i] for h in held], c.dtype), c[out]])) for i, c in enumerate(cols)],
            schema=batch.schema)


def shared_anchors(texts: DataFrame, anchors: Callable[[Block, np.ndarray], pa.RecordBatch]) -> DataFrame:
    """Staged rows of all names that stand in two places or more, and the sure rows."""
    ship(texts.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a partition sends the rows of a text once
        for block in blocks(batches, "text"):
            keys = block.rows.column(0).to_numpy()
            new = np.zeros(len(keys), bool)
            for i, k in enumerate(keys.tolist()):
                if k not in seen:
                    seen.add(k)
                    new[i] = True
            out = anchors(block, keys)
            if not new.all():
                stale = pa.array(keys[~new])
                again = pa.compute.is_in(out.column(2), value_set=stale)
                # a text may be new and repeated in one block: its rows are equal then
                first = pa.array(np.isin(out.column(2).to_numpy(), keys[new]))
                out = out.filter(pa.compute.or_(pa.compute.invert(again), first))
            yield out

    rows = texts.select("key", "text").mapInArrow(scan, ROWS)
    dealt = rows.repartition("fp").sortWithinPartitions("fp", "ctx", "key", "start")
    return stage(dealt.mapInArrow(lambda b: shared_rows(b, 0, [0, 1, 2, 3], sure=5), ROWS), "shared-anchors")


def contexts(rows: DataFrame, order: list[Column | str]) -> DataFrame:
    """Rows with ``count`` of their context, ``names`` (contexts of their name), ``first``.

    ``first`` marks the first row of the context in the given order. Counts and firsts
    combine before they are shuffled and are unique in the joins, so hot names can be split.
    """
    of = rows.filter("NOT sure")
    each = of.groupBy("fp", "ctx").agg(F.count("*").alias("count"), F.min(F.struct(*order)).alias("head"))
    each = stage(each, "contexts")
    many = each.groupBy("fp").agg(F.count("*").alias("names"))
    both = of.join(each, ["fp", "ctx"]).join(many, "fp")
    return both.withColumn("first", F.struct(*order) == F.col("head")).drop("head")
