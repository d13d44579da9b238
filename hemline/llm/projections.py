"""Approximate nearest neighbours: stable projections, a kd-tree, a chi-square stopping test.

Vectors are projected to ``DIMENSIONS`` coordinates by a fixed Gaussian (2-stable) matrix:
the squared ratio of projected and true distance follows a chi-square law with that many
degrees of freedom. The projected space is cut into cells by kd splits fitted on at most
``SAMPLE`` rows; every row goes to a cell, and a cell with many rows is dealt over several
sub-cells by id, so that repeated vectors cannot fill one task. A sub-cell's task builds a
kd-tree, verifies projected neighbours leaf by leaf on the original vectors, and stops
when the law says that, with probability ``CONFIDENCE``, a nearer row would have been seen
by now: chi2(r**2 / d**2) >= CONFIDENCE, for the next leaf at projected distance r and the
worst distance kept d.

A query first searches its home cell. Its worst distance there bounds which other cells
the test still asks for; it is sent to these alone.

Vectors that are null, zero, of another length than most, or that hold null or non-finite
components take no part, nor do rows with a null id. Rows with the query's id are its own.
Of rows that repeat a query's id the smallest vector is the query. Of rows that repeat
another id the nearest counts, once: the k results have different ids. With no rows there
are no results. Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hemline.llm.common import ship, stage

DIMENSIONS = 8
CONFIDENCE = 0.98
CELL_ROWS = 4096
MOST_CELLS = 4096
SAMPLE = 65536
LEAF = 32


def chi_square(x: np.ndarray, degrees: int = DIMENSIONS) -> np.ndarray:
    """Distribution function of the chi-square law for an even number of degrees."""
    half = np.asarray(x, float) / 2
    with np.errstate(over="ignore", invalid="ignore"):
        term, total = np.ones_like(half), np.ones_like(half)
        for k in range(1, degrees // 2):
            term = term * half / k
            total = total + term
        out = 1 - np.exp(-half) * total
    return np.where(half > 300, 1.0, out)


def stops(r2: np.ndarray, d2: float | np.ndarray, confidence: float = CONFIDENCE) -> np.ndarray:
    """Whether a search that kept squared distance d2 may stop before projected r2."""
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(np.asarray(r2) == 0, 0.0, np.asarray(r2) / d2)
    return np.where(np.isinf(d2), False, chi_square(ratio) >= confidence)


def kd_splits(points: np.ndarray, levels: int) -> np.ndarray:
    """(cells - 1, 2) axis and value of each split, in heap order."""
    out = np.zeros(((1 << levels) - 1, 2))
    parts = [points]
    for level in range(levels):
        halves = []
        for k, part in enumerate(parts):
            axis = int(np.argmax(np.ptp(part, 0))) if len(part) else 0
            value = float(np.median(part[:, axis])) if len(part) else 0.0
            out[(1 << level) - 1 + k] = axis, value
            left = part[:, axis] <= value
            halves += [part[left], part[~left]]
        parts = halves
    return out


def cells_of(points: np.ndarray, splits: np.ndarray) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    while len(splits) and len(node) and node[0] < len(splits):
        axis, value = splits[node, 0].astype(int), splits[node, 1]
        node = 2 * node + 1 + (points[np.arange(len(points)), axis] > value)
    return node - len(splits)


class KdTree:
    """Leaves of at most LEAF points with their boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray):
        leaves, todo = [], [np.arange(len(ids))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                leaves.append(rows)
                continue
            axis = int(np.argmax(np.ptp(points[rows], 0)))
            rows = rows[np.argsort(points[rows, axis], kind="stable")]
            todo += [rows[:len(rows) // 2], rows[len(rows) // 2:]]
        self.ids, self.vectors, self.leaves = ids, vectors, leaves
        self.repeats = len(np.unique(ids)) < len(ids)
        self.low = np.array([points[r].min(0) for r in leaves])
        self.high = np.array([points[r].max(0) for r in leaves])

    def search(self, key: int, vector: np.ndarray, point: np.ndarray, k: int, worst: float,
               confidence: float) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances and ids of up to k ids no farther than ``worst``, nearest first."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        r2 = (gap * gap).sum(1)
        order = np.argsort(r2, kind="stable")
        best_d, best_i = np.zeros(0), np.zeros(0, np.int64)
        at = 0
        while at < len(order):
            if stops(r2[order[at]], worst, confidence):
                break
            step = 2 if at < 8 else 8
            rows = np.concatenate([self.leaves[j] for j in order[at:at + step]])
            at += step
            diff = self.vectors[rows] - vector
            d2 = (diff * diff).sum(1)
            near = (d2 <= worst) & (self.ids[rows] != key)
            best_d = np.concatenate([best_d, d2[near]])
            best_i = np.concatenate([best_i, self.ids[rows][near]])
            if self.repeats:  # the nearest row of each id
                top = np.lexsort((best_d, best_i))
                top = top[np.diff(best_i[top], prepend=best_i[top[:1]] - 1) != 0]
                best_d, best_i = best_d[top], best_i[top]
            if len(best_d) > k:
                top = np.lexsort((best_i, best_d))[:k]
                best_d, best_i = best_d[top], best_i[top]
            if len(best_d) == k:
                worst = min(worst, best_d.max())
        top = np.lexsort((best_i, best_d))
        return best_d[top], best_i[top]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width)


def _lists(values: np.ndarray) -> pa.ListArray:
    at = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values.ravel()))


_ROWS = "cell int, salt int, query boolean, vec_id long, vec array<double>, proj array<double>, worst double"


def _search_rows(rows: DataFrame, k: int, width: int, confidence: float) -> DataFrame:
    """Search sub-cells: their index rows come first, then their queries, batch by batch."""
    names = [c.split()[0] for c in _ROWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, tree = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, salt, query, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            vectors, points = _matrix(batch.column(4), width), _matrix(batch.column(5), DIMENSIONS)
            worst = batch.column(6).to_numpy(zero_copy_only=False)
            edge = np.flatnonzero((np.diff(cell) != 0) | (np.diff(salt) != 0) | (np.diff(query.astype(int)) != 0)) + 1
            out_q, out_i, out_d = [], [], []
            for lo, hi in zip(np.append(0, edge), np.append(edge, len(ids))):
                mine = (int(cell[lo]), int(salt[lo]))
                if mine != key:
                    key, held, tree = mine, [], None
                if not query[lo]:
                    held.append((ids[lo:hi].copy(), vectors[lo:hi].copy(), points[lo:hi].copy()))
                    continue
                if not held:
                    continue
                if tree is None:
                    tree = KdTree(*(np.concatenate(x) for x in zip(*held)))
                for j in range(lo, hi):
                    d2, found = tree.search(int(ids[j]), vectors[j], points[j], k, worst[j], confidence)
                    out_q.append(np.full(len(found), ids[j]))
                    out_i.append(found)
                    out_d.append(d2)
            if out_q:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_i)),
                     pa.array(np.concatenate(out_d))], ["query_id", "vec_id", "d2"])

    dealt = rows.select(*names).repartition("cell", "salt").sortWithinPartitions("cell", "salt", "query")
    return dealt.mapInArrow(run, "query_id long, vec_id long, d2 double")


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part, but for the length."""
    vec = F.col(vec_col).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(
        ~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda x: x != 0))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
            vec_col: str = "embedding", confidence: float = CONFIDENCE, seed: int = 5) -> DataFrame:
    """The k nearest rows found of every row for which ``is_query`` (over vec_id) holds.

    Columns: query_id, rank, vec_id, score (Euclidean distance in double precision).
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, id_col, vec_col)
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = lengths["n"] if lengths else 1
    matrix = np.random.default_rng(seed).standard_normal((width, DIMENSIONS))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column(1), width) @ matrix
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(points)],
                                             ["vec_id", "vec", "proj"])

    index = stage(rows.filter(F.size("vec") == width).mapInArrow(
        project, "vec_id long, vec array<double>, proj array<double>"), "projected")
    # the splits are fitted on a bounded sample, chosen by a hash of the id
    sample = index.select("proj", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(SAMPLE)
    points = np.array([r["proj"] for r in sample.toArrow().to_pylist()]).reshape(-1, DIMENSIONS)
    total = index.count()
    levels = max(0, int(np.ceil(np.log2(max(1, min(MOST_CELLS, total / CELL_ROWS))))))
    splits = kd_splits(points, levels)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = cells_of(_matrix(batch.column(2), DIMENSIONS), splits).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], ["cell", "vec_id", "vec", "proj"])

    celled = index.mapInArrow(assign, "cell int, vec_id long, vec array<double>, proj array<double>")
    axes = [f(F.col("proj")[i]).alias(f"{n}{i}") for n, f in (("lo", F.min), ("hi", F.max)) for i in range(DIMENSIONS)]
    # one row per cell, MOST_CELLS at most
    found = celled.groupBy("cell").agg(F.count("*").alias("n"), *axes).collect()
    count, low, high = {}, {}, {}
    for r in found:
        count[r["cell"]] = r["n"]
        low[r["cell"]] = [r[f"lo{i}"] for i in range(DIMENSIONS)]
        high[r["cell"]] = [r[f"hi{i}"] for i in range(DIMENSIONS)]
    cells = np.array(sorted(count), np.int64)
    salts = np.array([-(-count[c] // CELL_ROWS) for c in cells], np.int64)
    lows = np.array([low[c] for c in cells]).reshape(-1, DIMENSIONS)
    highs = np.array([high[c] for c in cells]).reshape(-1, DIMENSIONS)

    def index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = cells_of(_matrix(batch.column(2), DIMENSIONS), splits)
            ids = batch.column(0).to_numpy()
            salt = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            salt %= salts[np.searchsorted(cells, cell)]
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype(np.int32)), pa.array(salt.astype(np.int32)), pa.array(np.zeros(n, bool)),
                 *batch.columns, pa.array(np.full(n, np.inf))],
                ["cell", "salt", "query", "vec_id", "vec", "proj", "worst"])

    def query_rows(home: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                points = _matrix(batch.column(2), DIMENSIONS)
                own = cells_of(points, splits)
                worst = batch.column(3).to_numpy()
                picks = []
                for j in range(len(points)):
                    if home:
                        near = np.flatnonzero(cells == own[j])
                    else:
                        gap = np.maximum(np.maximum(lows - points[j], points[j] - highs), 0)
                        near = np.flatnonzero((cells != own[j]) & ~stops((gap * gap).sum(1), worst[j], confidence))
                    n = salts[near]
                    part = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                    picks.append((np.full(len(part), j), np.repeat(cells[near], n), part))
                j, cell, salt = (np.concatenate(x) for x in zip(*picks))
                take = pa.array(j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(salt.astype(np.int32)),
                     pa.array(np.ones(len(j), bool)), *[c.take(take) for c in batch.columns]],
                    ["cell", "salt", "query", "vec_id", "vec", "proj", "worst"])
        return run

    asked = index.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("vec", "proj")).alias("q")) \
        .select("vec_id", "q.vec", "q.proj")
    stored = index.mapInArrow(index_rows, _ROWS)
    home = asked.withColumn("worst", F.lit(float("inf"))).mapInArrow(query_rows(True), _ROWS)
    top = Window.partitionBy("query_id").orderBy("d2", "vec_id")
    by_id = ["query_id", "vec_id"]
    first = _search_rows(stored.unionByName(home), k, width, confidence).groupBy(*by_id).agg(F.min("d2").alias("d2"))
    first = stage(first.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k), "home-neighbours")
    bound = first.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("d2").alias("worst"))
    away = asked.join(bound, "vec_id", "left").select(
        "vec_id", "vec", "proj", F.coalesce("worst", F.lit(float("inf"))).alias("worst"))
    second = _search_rows(stored.unionByName(away.mapInArrow(query_rows(False), _ROWS)), k, width, confidence)
    merged = first.drop("rank").unionByName(second).groupBy(*by_id).agg(F.min("d2").alias("d2")) \
        .withColumn("rank", F.row_number().over(top))
    return merged.filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.sqrt("d2").alias("score"))
