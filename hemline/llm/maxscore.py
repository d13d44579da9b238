"""Exact top-k inner products by MaxScore over shards of postings.

A component is quantized to ``floor(scale * x)``. Each dimension is a term; a shard holds its
rows' postings dimension by dimension and, in blocks of ``BLOCK`` rows, the least and greatest
impact of each. For a query a term's score in a block lies between a floor and a ceiling; what it
can add above the floor is its bound. Terms with the smallest bounds are non-essential as long as
all floors and their bounds together stay below the threshold, the query's k-th best score: a row
that rises above the floor in those alone cannot enter. With no essential term a whole block is
skipped. Otherwise the essential postings are traversed for all rows, and the other terms are
probed, largest bound first, for the rows that are still competitive. A shard's first block sets
the threshold, each later one raises it, and the shards' best rows are merged.

All arithmetic is on integers; floating point is used only where it holds them exactly. Scores
must fit 64 bits. Equal vectors score alike, so each different vector is indexed once, with its
k + 1 smallest ids: copies, however many, cost nothing beyond that and change no result.

Vectors that are null or hold null or non-finite components take no part, nor do rows with a null
id; a zero vector does. Of rows that repeat an id the smallest vector counts. Queries meet
vectors of their own length alone. Ties go to the smaller id. Empty tables, or no queries, give
an empty result. Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hemline.llm.common import ship, stage

K, SCALE = 5, 256
#: Rows whose bounds stand together; different vectors of a shard, and queries sent to it, at most.
BLOCK, SHARD, QUERIES = 2048, 1 << 16, 1 << 16
#: Whole doubles below this have no gaps.
EXACT = 2.0 ** 53
#: Tasks of the search; beyond that a task handles several groups in turn.
MOST_TASKS = 1 << 15
#: Terms that are probed before the competitive rows are gathered anew.
PROBES = 8


def quantized(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, vec) of the rows that take part, one per id, components as whole doubles."""
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    # floor would go through 64-bit integers and clip; whole doubles keep the value
    whole = F.transform("vec", lambda x: F.when(F.abs(x * scale) < 2.0 ** 52, F.floor(x * scale).cast("double"))
                        .otherwise(x * scale))
    return rows.filter(fine).select("vec_id", whole.alias("vec")).groupBy("vec_id").agg(F.min("vec").alias("vec"))


class Shard:
    """Postings by dimension, with bounds by block."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]]):
        """``ids``: the smallest ids of each vector, ascending."""
        self.ids, self.vectors, self.peak = ids, vectors, np.abs(vectors).max(initial=0)
        self._blocks: dict[bool, list] = {}

    def blocks(self, wide: bool) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """First row, postings, least and greatest impacts of each block; ``wide``: in integers of any size."""
        if wide not in self._blocks:
            vectors = _integers(self.vectors) if wide else self.vectors
            parts = [(lo, vectors[lo:lo + BLOCK]) for lo in range(0, len(vectors), BLOCK)]
            self._blocks[wide] = [(lo, np.ascontiguousarray(x.T), x.min(0), x.max(0)) for lo, x in parts]
        return self._blocks[wide]

    def search(self, key: int, query: np.ndarray, k: int, seen: list[int] | None = None) -> list[tuple[int, int]]:
        """Up to k (score, id), best first, without the id ``key``. ``seen`` counts rows, skipped blocks, probes."""
        best: list[tuple[int, int]] = []
        wide = len(query) * self.peak * np.abs(query).max(initial=0) >= EXACT
        if wide:
            query = _integers(query)
        for lo, postings, least, most in self.blocks(bool(wide)):
            threshold = -best[-1][0] if len(best) == k else None
            rows, scores = self._competitive(query, postings, least, most, threshold, seen)
            if len(rows) > 4 * k:
                rows, scores = self._top(rows, scores, k)
            for row, score in zip(rows.tolist(), scores.tolist()):
                best += [(-int(score), i) for i in self.ids[lo + row] if i != key]
            best = sorted(best)[:k]
        return [(-score, i) for score, i in best]

    @staticmethod
    def _top(rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows that are among the k + 1 best or tie with them; one of them may be the query's own."""
        bar = np.sort(scores)[-(k + 1)]
        keep = scores >= bar
        return rows[keep], scores[keep]

    @staticmethod
    def _competitive(query, postings, least, most, threshold, seen):
        """Rows of a block that reach the threshold, and their scores."""
        if not len(query):
            return np.arange(postings.shape[1]), np.zeros(postings.shape[1])
        ends = np.array([query * least, query * most])
        floor, bound = ends.min(0), ends.max(0) - ends.min(0)
        order = np.argsort(bound, kind="stable")
        reach = floor.sum() + np.cumsum(bound[order])  # what the first terms can reach together
        count = 0 if threshold is None else int(np.searchsorted(reach, threshold, side="left"))
        if seen is not None:
            seen[0] += postings.shape[1]
            seen[1] += count == len(order)
        if count == len(order):
            return np.zeros(0, np.int64), np.zeros(0)
        essential, others = order[count:], order[:count][::-1]
        scores = query[essential] @ postings[essential]
        rows = np.arange(postings.shape[1])
        if not count:
            return rows, scores
        top = np.maximum(query * least, query * most)
        left = top[others].sum()
        while True:
            near = scores + left >= threshold
            rows, scores = rows[near], scores[near]
            if not len(rows) or not len(others):
                return rows, scores
            some, others = others[:PROBES], others[PROBES:]
            if seen is not None:
                seen[2] += len(rows) * len(some)
            scores = scores + query[some] @ postings[np.ix_(some, rows)]
            left = top[others].sum() if len(others) else 0


def _integers(values: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _search(rows: DataFrame, k: int, groups: int) -> DataFrame:
    """Search groups (width, shard, part): their index rows come first, then their queries, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, vectors, ids, shard = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            width, part, block = (batch.column(c).to_numpy() for c in ("width", "shard", "part"))
            query = batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            edge = np.flatnonzero((np.diff(width) != 0) | (np.diff(part) != 0) | (np.diff(block) != 0)
                                  | (np.diff(query.astype(int)) != 0)) + 1
            found = []
            for lo, hi in zip(np.append(0, edge).tolist(), np.append(edge, len(query)).tolist()):
                mine = (int(width[lo]), int(part[lo]), int(block[lo]))
                if mine != key:
                    key, vectors, ids, shard = mine, [], [], None
                values = _matrix(batch.column("vec").slice(lo, hi - lo), mine[0])
                if not query[lo]:
                    vectors.append(values.copy())
                    ids += batch.column("ids").slice(lo, hi - lo).to_pylist()
                    continue
                if not vectors:
                    continue
                if shard is None:
                    shard, vectors = Shard(np.concatenate(vectors), ids), vectors[:1]
                for own, vector in zip(batch.column("vec_id").slice(lo, hi - lo).to_pylist(), values):
                    found += [(own, i, score) for score, i in shard.search(own, vector, k)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)],
                                                 ["query_id", "vec_id", "score"])

    by = ["width", "shard", "part"]
    dealt = rows.repartition(groups, *by).sortWithinPartitions(*by, F.col("vec_id").isNotNull())
    return dealt.mapInArrow(run, "query_id long, vec_id long, score long")


def top_products(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
                 vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The k rows of highest inner product for every row for which ``is_query`` (over vec_id) holds.

    Columns: query_id, rank, vec_id, score.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = stage(quantized(vectors, id_col, vec_col, scale).withColumn("width", F.size("vec")), "quantized")
    # at most k + 1 ids of each vector leave a task before they are shuffled
    first = Window.partitionBy("vec").orderBy("vec_id")
    index = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1).groupBy("width", "vec").agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids"))
    index, asked = stage(index, "different-vectors"), rows.filter(is_query).select("width", "vec_id", "vec")

    def numbers(df: DataFrame, most: int, spread: int) -> dict[int, int]:
        """Groups by vector length: at most ``most`` rows each, and enough groups to keep the cores busy."""
        found = df.groupBy("width").agg(F.count("*").alias("n")).collect()  # one row per length
        return {r["width"]: max(-(-r["n"] // most), min(spread, -(-r["n"] // BLOCK))) for r in found}

    shards = numbers(index, SHARD, spark.sparkContext.defaultParallelism)
    parts = numbers(asked, QUERIES, 1)
    grid = spark.createDataFrame([(w, n, parts.get(w, 0)) for w, n in shards.items()],
                                 "width int, shards long, parts long")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    # each block of queries goes to every shard of its vector length
    index, asked = (df.join(grid.filter("parts > 0"), "width") for df in (index, asked))
    stored = index.select("width", F.pmod(F.xxhash64("vec"), "shards").alias("shard"), every("parts").alias("part"),
                          F.lit(None).cast("long").alias("vec_id"), "vec", "ids")
    sent = asked.select("width", every("shards").alias("shard"), F.pmod(F.xxhash64("vec_id"), "parts").alias("part"),
                        "vec_id", "vec", F.lit(None).cast("array<long>").alias("ids"))
    groups = sum(n * parts.get(w, 0) for w, n in shards.items())
    found = _search(stored.unionByName(sent), k, max(1, min(groups, MOST_TASKS)))
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
