"""Pre-aggregation that a hot key cannot pin to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def collapse(df: DataFrame, keys: Sequence[Column | str], *figures: Column) -> DataFrame:
    """Group by all keys as one unit, before a coarser grouping by some of them.

    Rows that come from a join on one of the keys are already partitioned by it,
    and a plain grouping would keep them so: a key with a third of all rows then
    stays in one task, and the join may not be split either. A struct of the keys
    is a new grouping key, so partial sums are exchanged over all of them.
    """
    groups = df.groupBy(F.struct(*keys).alias("_unit")).agg(*figures)
    return groups.select("_unit.*", "*").drop("_unit")
