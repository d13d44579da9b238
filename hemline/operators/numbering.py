"""Row numbers, tiles and ranks over a whole table without a one-task window.

``row_number() over (order by ...)`` sends every row to one task. Here the
table is range-sorted across all tasks and written once to the shared staging
folder with each row's partition and place in it. A row's number is then its
place plus the number of rows in the partitions before it. Only the
per-partition counts (as many numbers as the sort has partitions) come to the
driver; they go back as one constant. Range boundaries are drawn on the
complete order, so one hot leading key is spread over many partitions as long as
the order is total.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from hemline.sources.staging import stage

# monotonically_increasing_id() documents its layout: the partition in the upper
# bits, the record's place within the partition in the lower 33.
_PLACE_BITS = 33


def number_rows(
    df: DataFrame, order: Sequence[Column | str], name: str, total: str | None = None
) -> DataFrame:
    """Add ``name`` = 1..n in the given order, and optionally ``total`` = n.

    The order must be total for the numbers to be repeatable. Runs the staged
    sort and a count over it; what comes back is a lazy scan of the staged table.
    """
    rows, count = _numbered(df, order, name)
    return rows.withColumn(total, F.lit(count).cast("bigint")) if total else rows


def _numbered(df: DataFrame, order: Sequence[Column | str], name: str, earlier: int = 0) -> tuple[DataFrame, int]:
    """The rows numbered from ``earlier`` + 1, and how many they are."""
    place = F.monotonically_increasing_id()
    rows = stage(df.orderBy(*order).withColumn("_place", place), "numbered")

    part = F.shiftright("_place", _PLACE_BITS).cast("int")
    counts = dict(rows.groupBy(part.alias("part")).count().collect())
    sizes = [counts.get(p, 0) for p in range(max(counts, default=0) + 1)]
    # one text instead of one literal per partition, folded to a constant array
    before = F.split(F.lit(",".join(map(str, accumulate(sizes, initial=earlier)))), ",")
    within = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    number = F.element_at(before.cast("array<bigint>"), part + 1) + within + 1
    return rows.withColumn(name, number).drop("_place"), sum(sizes)


#: Rows drawn per slice to cut slices of about equal size.
_SAMPLE = 1000


def number_slices(df: DataFrame, keys: Sequence[str], name: str, slices: int) -> DataFrame:
    """``number_rows`` in ascending order of ``keys``, NULLs first, as so many sorts one after the other.

    A sort holds all its rows in shuffle files; those of a slice are deleted before the next
    slice is sorted. The slices follow each other in the order and are cut by a sample, which decides
    their sizes only, not the numbers; rows equal in all keys fall into one slice. Each slice reads
    ``df`` twice, so it should be staged.
    """
    order = [F.asc_nulls_first(k) for k in keys]
    if slices < 2:
        return number_rows(df, order, name)
    rows = df.count()
    drawn = df.select(*keys).sample(fraction=min(1.0, _SAMPLE * slices / max(rows, 1)), seed=7).orderBy(*order).collect()
    bounds = [drawn[len(drawn) * i // slices] for i in range(1, slices)] if drawn else []
    kinds, key = dict(df.dtypes), F.struct(*keys)
    cuts = [F.struct(*[F.lit(b[k]).cast(kinds[k]).alias(k) for k in keys]) for b in bounds]
    parts, earlier = [], 0
    # fields of a struct compare as in the sort: one by one, NULL least
    for low, high in zip([None, *cuts], [*cuts, None]):
        inside = F.lit(True) if low is None else key >= low
        part, count = _numbered(df.filter(inside if high is None else inside & (key < high)), order, name, earlier)
        parts.append(part)
        earlier += count
    return reduce(DataFrame.unionByName, parts)


def tile_of(position: Column, rows: Column, tiles: int) -> Column:
    """NTILE from a 1-based position: the first ``rows % tiles`` tiles get one more."""
    size = F.floor(rows / tiles).cast("long")
    extra = (rows % tiles).cast("long")
    head = extra * (size + 1)
    small = F.greatest(size, F.lit(1))
    in_head = F.floor((position - 1) / (size + 1)) + 1
    in_tail = extra + F.floor((position - head - 1) / small) + 1
    return F.when(position <= head, in_head).otherwise(in_tail).cast("int")


def descending(value: Column) -> tuple[Column, bool]:
    """Mark a metric as ordered from its highest value, NULLs last."""
    return value, True


Metric = Column | tuple[Column, bool]


def _sort_parts(metric: Metric) -> tuple[Column, Column]:
    """Where NULLs go, and the ascending value, of one metric, as Spark would order it."""
    value, down = metric if isinstance(metric, tuple) else (metric, False)
    return F.when(value.isNull(), 1 if down else -1).otherwise(0), -value if down else value


def _positions(df: DataFrame, key: str, metrics: Mapping[str, Metric]) -> DataFrame:
    """(key, metric no., sort key) numbered per metric, all in one sort.

    Every metric contributes the same number of rows, so a row's position in
    its own metric is its global number less the metrics before it.
    """
    nulls, values = zip(*[_sort_parts(m) for m in metrics.values()])
    # an array takes the widest of its values' types, so none of them loses digits
    both = F.arrays_zip(F.array(*nulls).alias("_nulls"), F.array(*values).alias("_value"))
    long = df.select(key, F.posexplode(both).alias("_metric", "_sort"))
    long = long.select(key, "_metric", "_sort._nulls", "_sort._value")
    numbered = number_rows(long, ["_metric", "_nulls", "_value", key], "_row", total="_all")
    rows = F.floor(F.col("_all") / len(metrics)).cast("long")
    return numbered.withColumn("_n", rows).withColumn(
        "_position", F.col("_row") - F.col("_metric") * F.col("_n")
    )


def _spread(long: DataFrame, key: str, names: Sequence[str], value: Column) -> DataFrame:
    """Back to one row per key, one column per metric."""
    return long.groupBy(key).agg(
        *[F.max(F.when(F.col("_metric") == i, value)).alias(n) for i, n in enumerate(names)]
    )


def ntile_scores(df: DataFrame, key: str, tiles: int, metrics: Mapping[str, Metric]) -> DataFrame:
    """``key`` and, per metric, NTILE(tiles) in its order, ties by key.

    ``key`` must be unique. Metrics ascend, NULLs first, unless ``descending``.
    """
    placed = _positions(df, key, metrics)
    score = tile_of(F.col("_position"), F.col("_n"), tiles)
    return _spread(placed, key, list(metrics), score)


def rank_scores(df: DataFrame, key: str, metrics: Mapping[str, Metric]) -> DataFrame:
    """``key`` and, per metric, RANK() in its order.

    Rows that tie share the lowest position among them, found by grouping, so a
    value held by a third of the rows never gathers in one window.
    """
    placed = _positions(df, key, metrics)
    best = placed.groupBy("_metric", "_value").agg(F.min("_position").alias("_rank"))
    best = best.withColumnsRenamed({"_metric": "_m", "_value": "_v"})
    same = (F.col("_metric") == F.col("_m")) & F.col("_value").eqNullSafe(F.col("_v"))
    return _spread(placed.join(best, same), key, list(metrics), F.col("_rank"))
