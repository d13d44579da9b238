"""Profiling, validation and schema enforcement.

Every profile is one aggregate over one scan, whatever the number of columns,
and comes back as a small DataFrame rather than as driver-side numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from hemline.functions.lookups import STORE_WIDE_DISCOUNTS
from hemline.functions.text import has_chinese
from hemline.sources.staging import stage


# --- null and duplicate profiles ------------------------------------------

def _per_column(df: DataFrame, missing: Mapping[str, Column]) -> DataFrame:
    """One row per column: name, missing values, rows; one pass over the data."""
    totals = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(test).alias(f"c{i}") for i, test in enumerate(missing.values())],
    )
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(f"c{i}").alias("null_count"))
            for i, name in enumerate(missing)
        ]
    )
    return totals.select(F.inline(rows), "row_count")


def _nulls(df: DataFrame) -> dict[str, Column]:
    return {c: F.col(c).isNull() for c in df.columns}


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs per column."""
    return _per_column(df, _nulls(df)).drop("row_count")


def null_nan_profile(df: DataFrame) -> DataFrame:
    """NULLs and not-a-number values per column, with their share of all rows.

    Texts that read as not-a-number count; types that cannot hold one are only
    tested for NULL.
    """
    missing = _nulls(df)
    for name, kind in df.dtypes:
        if kind == "string":
            # parsing a word as a number is slow, so only parse what can be one
            word = F.col(name).rlike(r"(?i)^\s*[+-]?nan\s*$")
            missing[name] |= word & F.isnan(F.when(word, F.col(name).try_cast("double")))
        elif kind in ("float", "double"):
            missing[name] |= F.isnan(name)
    share = F.round(F.col("null_count") * 100 / F.nullif(F.col("row_count"), F.lit(0)), 2)
    return _per_column(df, missing).select(
        "column_name", "null_count", share.alias("null_percentage")
    )


def describe_table(df: DataFrame) -> DataFrame:
    """Name, type and declared nullability of every column, with its NULLs."""
    declared = F.create_map(
        *[
            x
            for f in df.schema.fields
            for x in (
                F.lit(f.name),
                F.struct(
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    F.lit(f.nullable).alias("nullable"),
                ),
            )
        ]
    )
    entry = F.element_at(declared, F.col("column_name"))
    return _per_column(df, _nulls(df)).select(
        "column_name",
        entry["data_type"].alias("data_type"),
        entry["nullable"].alias("nullable"),
        "null_count",
        "row_count",
    )


def _copies(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows beyond the first of each key; copies collapse before the shuffle."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias(name))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier row in every column."""
    return _copies(df, df.columns, "duplicate_rows")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """How many rows repeat an earlier key; a NULL key counts as one key."""
    return _copies(df, keys, "duplicate_keys")


def key_violations(df: DataFrame, *keys: str, bits: int | None = None) -> DataFrame:
    """The keys that more than one row has, and how many; none if the keys identify rows.

    Only hashed keys are exchanged for all rows; the keys themselves for rows that the filter
    over repeated hashes lets through.
    """
    bits = bits or REPEAT_BITS
    suspects = _marked(df.select(*keys), keys, repeat_filter(df, *keys, bits=bits), bits).filter("_repeated")
    return suspects.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


#: Bits of the filter that tells repeated keys: 16 MB, so that a task can hold it.
REPEAT_BITS = 1 << 27


def _key_place(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def repeat_filter(df: DataFrame, *keys: str, bits: int = REPEAT_BITS) -> DataFrame:
    """A staged bitmap filter over the keys that occur more than once.

    It never misses a repeated key; a key that occurs once passes as repeated with the chance
    that is the share of set bits. It has ``bits`` / 8 bytes at most, whatever the table's size.
    Only hashed keys, counted before their shuffle, are exchanged for it.
    """
    counted = df.groupBy(F.xxhash64(*keys).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    place = counted.filter("_n > 1").select(F.pmod("_key", F.lit(bits)).alias("_place"))
    return stage(place.groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bitmap")), "repeat-filter")


def drop_duplicate_rows(df: DataFrame, *keys: str, repeats: DataFrame | None = None,
                        bits: int = REPEAT_BITS) -> DataFrame:
    """Each different row once.

    Without keys all rows are exchanged over all columns. With keys that tell most rows apart,
    rows whose key occurs once (by ``repeats``, the table's ``repeat_filter`` with as many bits)
    pass as they are, pruned and unexchanged; only the others are compared. Equal rows have equal
    keys, so the result is the same.
    """
    if not keys:
        return df.dropDuplicates()
    repeats = repeat_filter(df, *keys, bits=bits) if repeats is None else repeats
    marked = _marked(df, keys, repeats, bits)
    once = marked.filter(~F.col("_repeated")).select(*df.columns)
    return once.unionByName(marked.filter("_repeated").select(*df.columns).dropDuplicates())


def _marked(df: DataFrame, keys: Sequence[str], repeats: DataFrame, bits: int) -> DataFrame:
    """The rows with ``_repeated``: whether the filter holds their key. It has ``bits`` / 8 bytes at most."""
    place = _key_place(keys, bits)
    return df.join(F.broadcast(repeats), F.bitmap_bucket_number(place) == F.col("_bucket"), "left").withColumn(
        "_repeated", F.col("_bitmap").isNotNull() & bit_set(F.col("_bitmap"), place))


def bit_set(bitmap: Column, place: Column) -> Column:
    """Whether the bitmap of a place's bucket holds the place."""
    spot = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(spot / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (spot % 8).cast("int")) == 1


# --- whole-column checks --------------------------------------------------

def check_all(df: DataFrame, passes: Column) -> DataFrame:
    """Rows, rows that pass, and whether all do. NULL does not pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total_count"), F.count_if(passes).alias("valid_count")
    ).withColumn("all_valid", F.col("total_count") == F.col("valid_count"))


def check_emails(df: DataFrame, column: str = "Email") -> DataFrame:
    return check_all(df, F.col(column).contains("@"))


def check_phone_prefix(df: DataFrame, column: str = "Telephone") -> DataFrame:
    return check_all(df, F.col(column).startswith("+"))


def untranslated(df: DataFrame, eligible: Column, column: str = "Name") -> DataFrame:
    """Eligible rows whose text still holds Chinese characters."""
    return df.filter(eligible & has_chinese(F.col(column)))


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag comparison: row counts, rows only on one side, and the verdict.

    One tagged union and one grouping: a row is unmatched by as much as its
    two counts differ, which is what EXCEPT ALL in both directions counts.
    """
    tagged = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    groups = tagged.groupBy(*left.columns).agg(
        F.count_if(F.col("_side") == 1).alias("_l"), F.count_if(F.col("_side") == -1).alias("_r")
    )
    gap = F.col("_l") - F.col("_r")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return groups.agg(
        total(F.col("_l")).alias("left_count"),
        total(F.col("_r")).alias("right_count"),
        total(F.greatest(gap, F.lit(0))).alias("only_left"),
        total(F.greatest(-gap, F.lit(0))).alias("only_right"),
    ).withColumn("same", (F.col("only_left") == 0) & (F.col("only_right") == 0))


# --- frequency, range, distinct, statistics -------------------------------

def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Frequency table, most frequent first; ties in value order."""
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), *[F.asc_nulls_first(c) for c in columns])
    )


def column_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, NULL counted as one, as a one-row DataFrame."""
    return distinct_values(df, column).agg(F.count(F.lit(1)).alias("distinct_count"))


def summary_table(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles, as numbers."""
    stats = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).summary()
    return stats.select(
        F.col("summary").alias("statistic"), *[F.col(c).cast("double").alias(c) for c in columns]
    )


def sample_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows for display; with an order, always the same ones."""
    return (df.orderBy(*order) if order else df).limit(n)


# --- characters -----------------------------------------------------------

def _characters(df: DataFrame, leftovers: Column) -> DataFrame:
    """Distinct characters of a text column.

    Distinct texts first: leftovers repeat heavily, so few rows are split.
    """
    texts = df.select(leftovers.alias("_text")).filter(F.length("_text") > 0).distinct()
    return texts.select(F.explode(F.split("_text", "")).alias("character")).filter(
        F.col("character") != ""
    ).distinct()


def non_digit_characters(df: DataFrame, column: str) -> DataFrame:
    return _characters(df, F.regexp_replace(column, "[0-9]", ""))


def extra_characters(df: DataFrame, column: str) -> DataFrame:
    """Characters that are neither a digit nor ``+``."""
    return _characters(df, F.regexp_replace(column, r"[+\p{Nd}]", ""))


def store_wide_rule(discounts: DataFrame, values: tuple[float, ...] = STORE_WIDE_DISCOUNTS) -> DataFrame:
    """Whether the promotions without a product group are just those of the given values."""
    no_group = F.col("Category").isNull() | F.col("SubCategory").isNull()
    return same_rows(discounts.filter(no_group), discounts.filter(F.col("Discount").isin(*values)))


# --- schema enforcement ---------------------------------------------------

def _typed(schema: StructType) -> list[Column]:
    return [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]


def enforce_schema(df: DataFrame, schema: StructType, bare: tuple[str, ...] = ()) -> DataFrame:
    """Columns, order and types of ``schema``; a NULL in a required column fails.

    ``bare`` columns are checked by a filter and stay the scan's own columns, so a table
    bucketed by them is still known to be.
    """

    def problem(field) -> Column:
        return F.raise_error(F.lit(f"NULL in required column {field.name}"))

    def column(field) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable and field.name not in bare:
            value = F.coalesce(value, problem(field).cast(field.dataType))
        return value.alias(field.name)

    for field in schema.fields:
        if field.name in bare and not field.nullable:
            df = df.filter(F.when(F.col(field.name).isNull(), problem(field).cast("boolean")).otherwise(True))
    return df.select(*[column(f) for f in schema.fields])


def _problems(schema: StructType) -> tuple[Column, Column]:
    """Names of required columns without a value, and of columns whose value has another type."""
    missing = [F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in schema.fields if not f.nullable]
    malformed = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
                 for f in schema.fields]
    return F.concat_ws(",", *missing), F.concat_ws(",", *malformed)


def conforming_rows(df: DataFrame, schema: StructType) -> DataFrame:
    """Typed rows with every required column present and every value of its type."""
    missing, malformed = _problems(schema)
    return df.filter((missing == "") & (malformed == "")).select(*_typed(schema))


def judged_rows(df: DataFrame, schema: StructType, *others: Column) -> DataFrame:
    """All rows, typed as far as they go, with the columns that are missing or malformed, and ``others``."""
    missing, malformed = _problems(schema)
    return df.select(
        *_typed(schema), missing.alias("missing_columns"), malformed.alias("malformed_columns"), *others)


def is_rejected() -> Column:
    """Whether a judged row lacks a required value or holds a malformed one."""
    return (F.col("missing_columns") != "") | (F.col("malformed_columns") != "")


def rejected_rows(df: DataFrame, schema: StructType) -> DataFrame:
    """The other rows, typed as far as they go, with the columns that are missing or malformed."""
    return judged_rows(df, schema).filter(is_rejected())


def column_types(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]
