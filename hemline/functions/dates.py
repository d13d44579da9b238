"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Upper bounds (exclusive) and labels of the age groups.
AGE_GROUPS = (
    (18, "Under 18"),
    (25, "18-24"),
    (35, "25-34"),
    (45, "35-44"),
    (55, "45-54"),
    (65, "55-64"),
)
OLDEST_GROUP = "65+"
NO_AGE = "Unknown"


def first_of_month(day: Column) -> Column:
    return F.trunc(day, "month")


def first_of_next_month(day: Column) -> Column:
    return F.add_months(F.trunc(day, "month"), 1)


def age_on(as_of: Column, born: Column) -> Column:
    """Whole years of 365.25 days; ages outside 0..120 are NULL."""
    years = F.floor(F.datediff(as_of, born) / F.lit(365.25)).cast("int")
    return F.when(years.between(0, 120), years)


def age_group(age: Column) -> Column:
    groups = F.when(age.isNull(), F.lit(NO_AGE))
    for limit, label in AGE_GROUPS:
        groups = groups.when(age < limit, F.lit(label))
    return groups.otherwise(F.lit(OLDEST_GROUP))


def months_of_operation(first: Column, last: Column) -> Column:
    """Calendar months from first to last day, both months counted; 0 if none."""
    months = F.months_between(last, first) + 1
    return F.coalesce(months, F.lit(0.0)).cast("decimal(5,1)")
