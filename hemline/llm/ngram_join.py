"""Similarity self-join on word n-gram sets, with count vectors in an R-tree as bound.

A document's set holds the hashes of its distinct five-word shingles. Documents with one
set are one node. Shingles are hashed into ``GROUPS`` groups; the counts by group are the
node's point, and the sum of coordinate minima of two points bounds their overlap from
above. For two boxes of an R-tree it is the sum of the minima of their upper corners.

Points alone don't route pairs: two unrelated documents of one size have near equal
counts. Nodes meet where they share a token of their prefix, the n - ceil(0.75 n) + 1
shingles that come first in one global order; two linked sets always share one. The order
takes rare shingles first, by counts over all documents in a table of fixed size, so a
passage that many documents share is in few prefixes.

1. In each token's bucket every node is paired with the smallest. Pairs that pass the
   point bound are verified on their sets. This collapses groups of near copies with a
   number of pairs that grows with the group, not its square.
2. The same once more in tokens whose nodes still lie in several components, with the
   token's most central node, which is as a rule the text that near copies stem from, and
   a few drawn ones.
3. Tokens that are still open are joined through an R-tree on the points of their nodes;
   only pairs of different components whose bound reaches the needed overlap come out,
   and are verified. So the pairs that remain are those just below the threshold.

No bucket, partner or candidate is capped. Linked documents end in one component.

Null or empty text, and text without words, has an empty set and is linked with nothing.
Equal rows are one node. A null id is a member like others, but the component's id is the
smallest id that is not null; ``one_of_each`` goes by rows, not ids. An empty table gives no rows; other columns may have any
names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hemline.llm.common import LOWER, ROW, Block, blocks, chosen, mix, numbered, prefix_hash, ship, span_hash, stage
from hemline.llm.components import components
from hemline.sources.staging import Scope

SHINGLE = 5
PERCENT = 75
GROUPS = 256
#: A count of this size or more is stored as this and taken as endless, which keeps bounds above overlaps.
FULL = 255
_ENDLESS = np.uint32(1 << 31)
#: Buckets of fewer nodes are compared pair by pair, larger ones through an R-tree.
SMALL = 48
CELLS = 1 << 18
FANOUT = 16
MEMBERS = 2000
#: Nodes drawn in each open bucket, besides the most central one.
DRAWN = 4


def shingles(block: Block, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, one after the other, and their bounds."""
    data = LOWER[block.data]
    start, end, before = block.words()
    words = span_hash(prefix_hash(data), start, end)
    prefix = prefix_hash(words)
    n = np.diff(before)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), count)
    first = before[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    hashes = span_hash(prefix, first, np.minimum(first + size, before[row + 1]))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    row, hashes = row[keep], hashes[keep]
    return hashes, np.searchsorted(row, np.arange(len(n) + 1))


def set_keys(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set, 0 for none."""
    raw = hashes.tobytes()
    return np.array([int.from_bytes(hashlib.blake2b(raw[8 * a:8 * b], digest_size=8).digest(), "little", signed=True)
                     if b > a else 0 for a, b in zip(at[:-1], at[1:])], np.int64)


def points(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts by group in one byte each, one row per set."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    group = (hashes >> np.uint64(13)).astype(np.int64) % GROUPS
    counts = np.bincount(row * GROUPS + group, minlength=(len(at) - 1) * GROUPS)
    return np.minimum(counts, FULL).astype(np.uint8).reshape(-1, GROUPS)


def from_bytes(column: pa.Array) -> np.ndarray:
    """Points of a binary column."""
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, GROUPS)
    return flat


def bounds_of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlaps of rows of x and y (bytes): sums of coordinate minima."""
    least = np.minimum(x, y)
    return np.where((least == FULL).any(1), np.int64(_ENDLESS), least.sum(1, dtype=np.int64))


def cells_of(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> np.uint64(40)).astype(np.int64) % CELLS


def needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Least overlap of linked sets of n and m members."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


class RTree:
    """Boxes over count vectors (bytes), packed by size and leading coordinates, FANOUT to a node."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((vectors[:, 1], vectors[:, 0], sizes))
        self.vectors, self.sizes = vectors[self.order], sizes[self.order]
        self.levels = [(self.vectors, self.sizes, self.sizes)]
        while len(self.levels[-1][0]) > FANOUT:
            high, least, most = self.levels[-1]
            cut = np.arange(0, len(high), FANOUT)
            self.levels.append((np.maximum.reduceat(high, cut), np.minimum.reduceat(least, cut),
                                np.maximum.reduceat(most, cut)))

    def partners(self, vector: np.ndarray, size: int) -> np.ndarray:
        """Rows whose bound allows a link with a vector of that size, as numbered at first."""
        level = len(self.levels) - 1
        nodes = np.arange(len(self.levels[level][0]))
        while True:
            high, least, most = self.levels[level]
            near = (bounds_of(high[nodes], vector) >= needed(least[nodes].astype(np.int64), size)) \
                & (100 * most[nodes] >= PERCENT * size) & (PERCENT * least[nodes] <= 100 * size)
            nodes = nodes[near]
            if level == 0:
                return self.order[nodes]
            level -= 1
            nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            nodes = nodes[nodes < len(self.levels[level][0])]


def _sets(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes, at = shingles(block)
    return hashes, at, set_keys(hashes, at)


def nodes_and_counts(rows: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n, key, point) of every document, and how often shingles fall in each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        names = ["doc_id", "n", "key", "point", "cells"]
        for block in blocks(batches):
            hashes, at, keys = _sets(block)
            total += np.bincount(cells_of(hashes), minlength=CELLS)
            vectors = points(hashes, at)
            yield pa.RecordBatch.from_arrays(
                [block.rows.column(0), pa.array(np.diff(at)), pa.array(keys),
                 pa.array([v.tobytes() for v in vectors], pa.binary()), pa.nulls(len(keys), pa.binary())], names)
        # the partition's counts, in 64 rows of fixed size numbered by n
        parts = [p.astype(np.uint32).tobytes() for p in np.split(total, 64)]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(64, pa.int64()), pa.array(np.arange(64)), pa.array(np.zeros(64, np.int64)),
             pa.nulls(64, pa.binary()), pa.array(parts, pa.binary())], names)

    found = stage(rows.mapInArrow(run, "doc_id long, n long, key long, point binary, cells binary"), "sets")

    def add(key, table):
        total = sum(np.frombuffer(x, np.int64) for x in table.column("cells").to_pylist())
        return pa.table({"n": [key[0].as_py()], "cells": [total.tobytes()]})

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((64, CELLS // 64), np.int64)
        for batch in batches:
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[n] += np.frombuffer(raw, np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(64)), pa.array([x.tobytes() for x in sums], pa.binary())], ["n", "cells"])

    # a task's rows become 64, a group then holds one row per task, and 64 rows are left
    sums = found.filter("cells IS NOT NULL").select("n", "cells").mapInArrow(partial, "n long, cells binary")
    sums = sums.groupBy("n").applyInArrow(add, "n long, cells binary")
    counts = np.zeros(CELLS, np.int64)
    for r in sums.collect():
        width = CELLS // 64
        counts[r["n"] * width:(r["n"] + 1) * width] = np.frombuffer(r["cells"], np.int64)
    return found.filter("cells IS NULL").drop("cells"), counts


def buckets(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """(token, n, key, leader): nodes of every token that is in two prefixes or more.

    ``leader`` is the smallest node of the token's bucket.
    """
    shared = rows.sparkSession.sparkContext.broadcast(counts.astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.uint64))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # nodes of this partition: copies send their tokens once
        for block in blocks(batches):
            hashes, at, keys = _sets(block)
            n = np.diff(at)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((hashes, shared.value[cells_of(hashes)], row))
            place = np.arange(len(row)) - np.repeat(at[:-1], n)
            length = n - (-(-PERCENT * n // 100)) + 1
            new = np.zeros(len(n), bool)
            for i, key in enumerate(keys.tolist()):
                if n[i] and key not in seen:
                    seen.add(key)
                    new[i] = True
            take = (place < length[row]) & new[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[order][take].view(np.int64)), pa.array(n[row[take]].astype(np.int32)),
                 pa.array(keys[row[take]]), pa.array(place[take].astype(np.int32))], ["token", "n", "key", "pos"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by token, size and key; a bucket may span batches."""
        last = None  # token, size and key of the last row, its leader, whether it is out
        for batch in batches:
            if not batch.num_rows:
                continue
            token, n, key, pos = (c.to_numpy() for c in batch.columns)
            fresh = np.ones(len(token), bool)  # a new token, or a new node of it
            fresh[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
            if last is not None and token[0] == last[0] and key[0] == last[2]:
                fresh[0] = False
            token, n, key, pos = token[fresh], n[fresh], key[fresh], pos[fresh]
            if not len(token):
                continue
            opens = np.ones(len(token), bool)
            opens[1:] = token[1:] != token[:-1]
            if last is not None and token[0] == last[0]:
                opens[0] = False
            first = np.maximum.accumulate(np.where(opens, np.arange(len(token)), -1))
            leader = np.where(first >= 0, key[first], last[3] if last is not None else 0)
            more = np.append(~opens[1:], False)  # another node of the same token follows here
            out = ~opens | more
            held = [last[:5]] if not opens[0] and not last[5] else []
            rows_ = [np.concatenate([np.array([h[i] for h in held], x.dtype), x[out]])
                     for i, x in enumerate([token, n, key, leader, pos])]
            last = (token[-1], n[-1], key[-1], leader[-1], pos[-1], bool(out[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows_], ["token", "n", "key", "leader", "pos"])

    tokens = rows.mapInArrow(prefixes, "token long, n int, key long, pos int")
    dealt = tokens.repartition("token").sortWithinPartitions("token", "n", "key")
    return dealt.mapInArrow(meet, "token long, n int, key long, leader long, pos int")


def candidate_sets(rows: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """key, members (64-bit hashes) and short (their lowest 16 bits, sorted) of the nodes in some pair; staged.

    The sets are computed anew from one document of each node.
    """
    wanted = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    owners = nodes.join(wanted, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    texts = rows.join(owners.select(F.col("doc_id").alias("__id")).distinct(),
                      rows["doc_id"].eqNullSafe(F.col("__id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            hashes, at, keys = _sets(block)
            sets = [hashes[a:b] for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array([x.tobytes() for x in sets], pa.binary()),
                 pa.array([np.sort(x.astype(np.uint16)).tobytes() for x in sets], pa.binary())],
                ["key", "members", "short"])

    found = texts.mapInArrow(run, "key long, members binary, short binary")
    return stage(found.join(wanted, "key", "left_semi").dropDuplicates(["key"]), "candidate-sets")


def common_members(mine: np.ndarray, other: np.ndarray) -> int:
    """Overlap of two sorted sets of hashes."""
    place = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
    return int((mine[place] == other).sum())


def common_counts(mine: np.ndarray, other: np.ndarray) -> int:
    """Sum of minima of the counts of two sorted lists: a bound of the overlap of the sets they shorten."""
    value, count = np.unique(other, return_counts=True)
    held = np.searchsorted(mine, value, "right") - np.searchsorted(mine, value, "left")
    return int(np.minimum(count, held).sum())


def reaching(pairs: DataFrame, sets: DataFrame, column: str, kind: type, common) -> DataFrame:
    """The pairs (a, b) whose overlap, by ``common`` over that column, reaches what a link needs.

    A pair sends b's list to a; an ``a`` with many partners is dealt over several tasks.
    """
    sets = sets.select("key", F.col(column).alias("members"))
    size = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    salted = pairs.join(size, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("salt"))
    partners = salted.join(sets, salted["b"] == sets["key"]).select("a", "salt", "b", "members")
    own = size.join(sets, size["a"] == sets["key"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"),
        F.lit(None).cast("long").alias("b"), "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, mine = None, None
        for batch in batches:
            a, b = [], []
            for x, _, y, members in zip(*[c.to_pylist() for c in batch.columns]):
                other = np.frombuffer(members, kind)
                if y is None:
                    key, mine = x, other
                    continue
                if key == x and common(mine, other) >= needed(len(mine), len(other)):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    dealt = own.unionByName(partners).repartition("a", "salt").sortWithinPartitions("a", "salt", "b")
    return dealt.mapInArrow(run, "a long, b long")


def verify(rows: DataFrame, nodes: DataFrame, pairs: DataFrame, label: str) -> DataFrame:
    """The staged links (a, b) among candidate pairs (a, b) of keys, by overlap of their sets.

    A list of the hashes' lowest 16 bits, counts in 65,536 groups, takes a quarter of a set's bytes and
    bounds its overlap, so pairs that are no links seldom send their sets.
    """
    with Scope(rows.sparkSession) as scope:
        pairs = stage(pairs, f"{label}-pairs")
        sets = candidate_sets(rows, nodes, pairs)
        near = stage(reaching(pairs, sets, "short", np.uint16, common_counts), f"{label}-near")
        return scope.keep(stage(reaching(near, sets, "members", np.uint64, common_members), f"{label}-links"))


def linked(links: DataFrame, label: str) -> DataFrame:
    """The staged components of links."""
    with Scope(links.sparkSession) as scope:
        return scope.keep(stage(components(links), label))


def bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose sizes and points allow a link."""
    size = nodes.groupBy("key").agg(F.first("n").alias("n"))
    pairs = pairs.join(size.select(F.col("key").alias("a"), F.col("n").alias("na")), "a").join(
        size.select(F.col("key").alias("b"), F.col("n").alias("nb")), "b")
    # points are wide: they are joined to the pairs that their sizes leave
    pairs = pairs.filter((100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")))
    point = nodes.groupBy("key").agg(F.first("point").alias("point"))
    both = pairs.join(point.select(F.col("key").alias("a"), F.col("point").alias("pa")), "a").join(
        point.select(F.col("key").alias("b"), F.col("point").alias("pb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = from_bytes(batch.column(4)), from_bytes(batch.column(5))
            na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            keep = pa.array(bounds_of(x, y) >= needed(na, nb))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return both.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, "a long, b long")


def still_open(mixed: DataFrame, found: DataFrame) -> DataFrame:
    """Staged (token, n, key, pos, component) of the tokens whose nodes lie in two components or more."""
    rows = mixed.join(found, mixed["key"] == found["node"], "left").select(
        "token", "n", "key", "pos", F.coalesce("component", "key").alias("component"))
    with Scope(mixed.sparkSession) as scope:
        rows = stage(rows, "bucket-components")
        # minima combine before the shuffle, so a token of very many nodes is no hot task here
        open_ = rows.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y")
        return scope.keep(stage(rows.join(open_.select("token"), "token"), "open-buckets"))


def central_pairs(rows: DataFrame, drawn: int = DRAWN) -> DataFrame:
    """Pairs of some nodes of each open token with its nodes of other components.

    The nodes are the most central one and ``drawn`` by hashes of their keys, which favour
    the same nodes in all tokens. A node is central when it meets many others, summed over
    its tokens: the text that near copies were made from is closer to all of them than they
    are to each other. Pairs grow with the bucket, not with its square.
    """
    size = rows.groupBy("token").agg(F.count("*").alias("size"))
    weight = rows.join(size, "token").groupBy("key").agg(F.sum("size").alias("weight"))
    orders = [F.col("weight"), *[F.xxhash64(F.lit(k), F.col("key")) for k in range(drawn)]]
    best = [F.max(F.struct(o.alias("order"), "key", "component")) for o in orders]
    heavy = rows.join(weight, "key").groupBy("token").agg(*[x.alias(f"c{i}") for i, x in enumerate(best)])
    centres = F.array_distinct(F.array(*[
        F.struct(F.col(f"c{i}.key").alias("key"), F.col(f"c{i}.component").alias("component"))
        for i in range(len(best))]))
    met = rows.join(heavy.select("token", centres.alias("centres")), "token").select(
        "key", F.explode(F.filter("centres", lambda c: c["component"] != F.col("component"))).alias("c"))
    return met.select(F.least("key", "c.key").alias("a"), F.greatest("key", "c.key").alias("b")).distinct()


def remaining(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of different components in one open bucket whose R-tree bound allows a link.

    A pair that needs an overlap of k shares a token among the first n - k + 1 of either
    set, so other meetings of it are passed over.
    """
    point = nodes.groupBy("key").agg(F.first("point").alias("point"))
    rows = rows.join(point, "key").select("token", "n", "key", "component", "point", "pos")

    def through_tree(n, key, comp, vectors, pos) -> list[np.ndarray]:
        if len(set(comp.tolist())) < 2:
            return []
        tree, out = RTree(vectors, n.astype(np.int64)), []
        for i in range(len(n)):
            near = tree.partners(vectors[i], int(n[i]))
            need = needed(n[near].astype(np.int64), int(n[i]))
            near = near[(near > i) & (comp[near] != comp[i]) & (pos[i] <= n[i] - need) & (pos[near] <= n[near] - need)]
            if len(near):
                out.append(np.stack([np.minimum(key[near], key[i]), np.maximum(key[near], key[i])]))
        return out

    def pair_by_pair(n, key, comp, vectors, pos, run) -> list[np.ndarray]:
        """All pairs inside short runs; ``run`` numbers them, the rows of one stand together."""
        first = np.searchsorted(run, run, side="left")
        before = np.arange(len(run)) - first
        j = np.repeat(np.arange(len(run)), before)
        i = first[j] + np.arange(len(j)) - np.repeat(np.cumsum(before) - before, before)
        low, high = np.minimum(n[i], n[j]).astype(np.int64), np.maximum(n[i], n[j]).astype(np.int64)
        need = needed(low, high)
        ok = (comp[i] != comp[j]) & (100 * low >= PERCENT * high) \
            & (pos[i] <= n[i] - need) & (pos[j] <= n[j] - need)
        i, j, need = i[ok], j[ok], need[ok]
        out = []
        for lo in range(0, len(i), 1 << 15):
            part = slice(lo, lo + (1 << 15))
            near = bounds_of(vectors[i[part]], vectors[j[part]]) >= need[part]
            a, b = key[i[part][near]], key[j[part][near]]
            out.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None  # rows of the last token so far
        gathered: list[np.ndarray] = []  # pairs meet in many tokens; each task sends a pair once a million

        def sent(least: int) -> Iterator[pa.RecordBatch]:
            if sum(g.shape[1] for g in gathered) > least:
                a, b = np.unique(np.concatenate(gathered, 1), axis=1)
                gathered.clear()
                gathered.append(np.stack([a, b]))
                if len(a) > least // 2:
                    gathered.clear()
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        def close(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            token = cols[0]
            opens = np.append(True, token[1:] != token[:-1])
            at = np.flatnonzero(opens)
            size = np.diff(np.append(at, len(token)))
            number = np.cumsum(opens) - 1
            short = size[number] <= SMALL
            found = pair_by_pair(*[c[short] for c in cols[1:]], number[short])
            for k in np.flatnonzero(size > SMALL):
                found += through_tree(*[c[at[k]:at[k] + size[k]] for c in cols[1:]])
            gathered.extend(found)
            yield from sent(1 << 20)

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in range(4)] + [from_bytes(batch.column(4)), batch.column(5).to_numpy()]
            if held:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            held = [c[cut:] for c in cols]
            if cut:
                yield from close([c[:cut] for c in cols])
        if held:
            yield from close(held)
        yield from sent(0)

    dealt = rows.repartition("token").sortWithinPartitions("token")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def members(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: doc_id, n_shingles, component (a node, of no meaning where n_shingles is 0)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with Scope(spark) as scope:
        nodes, counts = nodes_and_counts(rows)
        mixed = stage(buckets(rows, counts), "buckets")
        stars = mixed.filter("leader != key").select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct()
        links = verify(rows, nodes, bounded(stars, nodes), "star")
        found = linked(links, "star-components")
        open_ = still_open(mixed, found)
        scope.drop(mixed)
        central = verify(rows, nodes, bounded(central_pairs(open_), nodes), "central")
        if not central.isEmpty():
            links = stage(links.unionByName(central), "links-so-far")
            found = linked(links, "central-components")
            before, open_ = open_, still_open(open_.drop("component"), found)
            scope.drop(before)
        more = verify(rows, nodes, remaining(open_, nodes), "open")
        if not more.isEmpty():
            found = linked(links.unionByName(more), "components")
        return scope.keep(nodes.join(found, nodes["key"] == found["node"], "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component")))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    member = members(docs, id_col, text_col)
    full = member.filter("n_shingles > 0")
    least = full.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return full.join(least, "component").select("doc_id", "n_shingles", "component_id").unionByName(
        member.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the row with the smallest id (null last, then by row), with all columns.

    Rows with an empty set are linked with nothing, so all of them stay.
    """
    rows = numbered(docs)
    member = members(rows, ROW, text_col).withColumnRenamed("doc_id", "__member")
    ids = rows.select(F.col(ROW).alias("__number"), F.col(id_col).cast("long").alias("__id"))
    full = member.filter("n_shingles > 0").join(ids, F.col("__member") == F.col("__number"))
    first = F.min(F.struct(F.col("__id").isNull(), "__id", "__number"))
    kept = full.groupBy("component").agg(first.alias("first")).select(F.col("first.__number").alias("__kept"))
    return chosen(rows, kept.unionByName(member.filter("n_shingles = 0").select(F.col("__member").alias("__kept"))))
