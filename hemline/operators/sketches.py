"""Summaries that merge: moments and a quantile sketch by part, added up without the rows.

A part's row is some tens of kilobytes whatever the number of its values, so summaries of
any span of parts cost the parts, not the rows. Count, mean, deviation and extremes of the
merged parts are those of all rows; quantiles are within ``rank_error`` of their rank.
NULL and NaN are no values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Size of a sketch; a larger one is more exact and takes eight bytes more a step, several times over.
SKETCH_K = 4096
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def rank_error(k: int = SKETCH_K) -> float:
    """How far a quantile's rank may be from the one asked for, as a share of all values.

    The sketch's published bound, which 99 of 100 sketches keep for one quantile.
    """
    return 2.296 / k ** 0.9021


def _value(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def part_summaries(df: DataFrame, part: str, *columns: str, k: int = SKETCH_K) -> DataFrame:
    """One row per part: a struct of moments and sketch by column."""
    figures = []
    for name in columns:
        value = _value(name)
        figures.append(F.struct(
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(value)).alias("squares"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"),
        ).alias(name))
    return df.groupBy(part).agg(*figures)


def merged_summary(parts: DataFrame, *columns: str) -> DataFrame:
    """One row per column (metric): the summary of all parts together.

    The deviation is that of a sample. A metric without values has count 0 and no figures.
    """
    rows = []
    for name in columns:
        n, mean = F.col(f"{name}.count"), F.col(f"{name}.mean")
        filled = n > 0
        rows.append(F.struct(
            F.lit(name).alias("metric"),
            F.coalesce(F.sum(n), F.lit(0)).alias("count"),
            F.sum(n * mean).alias("_total"),
            F.sum(F.col(f"{name}.squares") + n * mean * mean).alias("_squares"),
            F.min(f"{name}.min").alias("min"),
            F.max(f"{name}.max").alias("max"),
            F.kll_merge_agg_double(F.when(filled, F.col(f"{name}.sketch"))).alias("_sketch"),
        ))
    merged = parts.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))
    mean = F.col("_total") / F.nullif("count", F.lit(0))
    squares = F.greatest(F.col("_squares") - F.col("_total") * mean, F.lit(0.0))
    return merged.select(
        "metric", "count", mean.alias("mean"),
        F.when(F.col("count") > 1, F.sqrt(squares / (F.col("count") - 1))).alias("stddev"),
        "min",
        *[F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(q))).alias(label)
          for label, q in QUARTILES.items()],
        "max",
    )


def quartiles_within(df: DataFrame, merged: DataFrame, column: str, bound: float) -> DataFrame:
    """Whether each merged quartile of ``column`` stands at its rank among the rows, give or take ``bound``.

    One pass over the rows. A value that many rows share stands at all their ranks.
    """
    asked = merged.filter(F.col("metric") == column)
    value = _value(column)
    rows = df.select(value.alias("_v"), *[asked.select(label).scalar().alias(label) for label in QUARTILES])
    n = F.count("_v")
    checks = [
        ((F.count_if(F.col("_v") < F.col(label)) <= n * (q + bound))
         & (F.count_if(F.col("_v") <= F.col(label)) >= n * (q - bound))).alias(f"{label}_within")
        for label, q in QUARTILES.items()
    ]
    return rows.agg(F.lit(column).alias("metric"), *checks)
