"""Bronze to silver: one lazy DataFrame function per table.

The quality checks that go with each job are in ``operators.quality``; run them
on the input or output as needed, they are not part of the data path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from hemline.functions import lookups as L
from hemline.functions.phone import add_dial_code, clean_phone
from hemline.functions.text import (
    default_nulls, lookup_or_keep, replace_within, standardize_columns, strip_titles,
)
from hemline.operators.joins import actual_employee_counts, translate_names
from hemline.operators.numbering import number_rows
from hemline.operators.quality import drop_duplicate_rows


def translate_places(df: DataFrame) -> DataFrame:
    """English country and city names where the dictionaries have them."""
    return df.withColumns(
        {
            "Country": lookup_or_keep(F.col("Country"), L.COUNTRY_NAMES),
            "City": lookup_or_keep(F.col("City"), L.CITY_NAMES),
        }
    )


def clean_phones(df: DataFrame) -> DataFrame:
    return df.withColumn("Telephone", clean_phone(F.col("Telephone")))


def add_dial_codes(df: DataFrame) -> DataFrame:
    return df.withColumn("Telephone", add_dial_code(F.col("Telephone"), F.col("Country")))


def clean_names(df: DataFrame, strict: bool = False) -> DataFrame:
    return df.withColumn("Name", strip_titles(F.col("Name"), strict))


def rename_children_range(df: DataFrame) -> DataFrame:
    return df.replace([L.CHILDREN_RANGE_OLD], [L.CHILDREN_RANGE_NEW], "SubCategory")


def customers(bronze: DataFrame, translations: DataFrame | None = None) -> DataFrame:
    """Clean customers.

    Phones are completed after countries are in English and before their
    spelling is standardised, because the dialling codes are keyed on it.
    """
    df = translate_places(clean_names(bronze))
    if translations is not None:
        df = translate_names(df, translations, F.col("Country") == L.CHINESE_COUNTRY)
    df = add_dial_codes(clean_phones(df))
    df = default_nulls(df, {"JobTitle": L.NO_VALUE})
    return standardize_columns(df, ["Name", "City", "Country", "Gender", "JobTitle"])


def employees(bronze: DataFrame, translations: DataFrame | None = None,
              chinese_stores: Sequence[int] = L.CHINESE_STORES) -> DataFrame:
    df = clean_names(bronze)
    if translations is not None:
        df = translate_names(df, translations, F.col("StoreID").isin(*chinese_stores))
    return standardize_columns(df, ["Name", "Position"])


def products(bronze: DataFrame) -> DataFrame:
    df = default_nulls(bronze, {"Color": L.NO_VALUE, "Sizes": L.NO_SIZE})
    return standardize_columns(rename_children_range(df), ["Category", "SubCategory", "Color"])


def discounts(bronze: DataFrame) -> DataFrame:
    """Clean promotions with a DiscountID from 1, by discount value.

    Equal values are numbered in the order of their other columns.
    """
    df = default_nulls(
        bronze, {"Category": L.EVERY_CATEGORY, "SubCategory": L.EVERY_CATEGORY}
    )
    df = rename_children_range(df)
    order = ["Discount", "StartDate", "EndDate", "Category", "SubCategory", "Description"]
    df = number_rows(df, [F.asc_nulls_first(c) for c in order], "DiscountID")
    df = df.withColumn("DiscountID", F.col("DiscountID").cast("int"))
    df = df.select(
        "StartDate", "EndDate", "DiscountID", "Discount", "Description", "Category", "SubCategory"
    )
    return standardize_columns(df, ["Category", "SubCategory"])


def name_stores(bronze: DataFrame) -> DataFrame:
    """English places and store names in standard spelling."""
    df = translate_places(bronze)
    df = df.withColumn("StoreName", replace_within(F.col("StoreName"), L.CITY_NAMES))
    return standardize_columns(df, ["Country", "City", "StoreName"])


def employee_discrepancies(stores: DataFrame, staff: DataFrame) -> DataFrame:
    """Stores whose stated number of employees differs from the actual one."""
    counted = actual_employee_counts(stores, staff)
    return counted.filter(F.col("NumberOfEmployees") != F.col("Actual_Employee_Count")).select(
        "StoreID", "StoreName", "NumberOfEmployees", "Actual_Employee_Count"
    )


def reconcile_employees(stores: DataFrame, staff: DataFrame) -> DataFrame:
    """State the actual number of employees; an unstated number stays NULL."""
    stated = F.col("NumberOfEmployees")
    actual = F.col("Actual_Employee_Count").cast("int")
    return (
        actual_employee_counts(stores, staff)
        .withColumn("NumberOfEmployees", F.when(stated.isNotNull(), actual))
        .select(*stores.columns)
    )


def stores(bronze: DataFrame, silver_employees: DataFrame) -> DataFrame:
    return reconcile_employees(name_stores(bronze), silver_employees)


def clean_transactions(df: DataFrame) -> DataFrame:
    """The column work of the transactions job, for rows known to be distinct."""
    df = default_nulls(df, {"Color": L.NO_VALUE, "Size": L.NO_SIZE})
    return standardize_columns(df, ["Color", "TransactionType", "PaymentMethod"])


#: Tells lines apart but for copies.
LINE_KEY = ("InvoiceID", "Line")


def transactions(bronze: DataFrame, repeats: DataFrame | None = None) -> DataFrame:
    """Clean lines without copies; ``repeats`` is their ``repeat_filter`` over LINE_KEY, if it is at hand.

    The lines are read up to three times, so they are best stored or staged.
    """
    return clean_transactions(drop_duplicate_rows(bronze, *LINE_KEY, repeats=repeats))
