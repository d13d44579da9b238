"""CSV exchange: header, comma, all values quoted, backslash escape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hemline.sources.staging import freed_shuffles

#: Column of the text of a record that has too few or too many fields, or a value of another type.
RECORD = "_record"

_FORM = {"header": "true", "quote": '"', "escape": "\\"}


class HeaderMismatch(ValueError):
    """A file's header lacks a column of the schema."""


def _in_file_order(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """The schema in the order of the header of the first file; unknown columns are text."""
    header = spark.read.options(**_FORM).csv(path).columns
    known = {f.name: f for f in schema.fields}
    missing = [name for name in known if name not in header]
    if header and missing:
        raise HeaderMismatch(f"{path}: the header lacks {', '.join(missing)}")
    return StructType([known.get(name, StructField(name, StringType())) for name in header] or schema.fields)


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True,
             records: bool = False) -> DataFrame:
    """The schema's columns, permissive: a value that does not parse becomes NULL.

    Columns are found by the header's names, in whatever order, and surplus ones are left out;
    a file whose header differs from the first one's fails. Without a header they are found by
    place. With ``records`` the column RECORD holds the text of each broken record.
    """
    fields = _in_file_order(spark, path, schema) if header else schema
    names = list(schema.names)
    options = _FORM | {"mode": "PERMISSIVE", "header": str(header).lower(), "enforceSchema": str(not header).lower()}
    if records:
        # all columns are parsed, whatever is read, so that a record's length is seen
        options |= {"columnNameOfCorruptRecord": RECORD, "columnPruning": "false"}
        fields, names = StructType([*fields.fields, StructField(RECORD, StringType())]), [*names, RECORD]
    return spark.read.options(**options).schema(fields).csv(path).select(*names)


def read_csv_text(spark: SparkSession, path: str, schema: StructType, header: bool = True,
                  records: bool = False) -> DataFrame:
    """The schema's columns as text, so that malformed values can be told from missing ones."""
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    return read_csv(spark, path, text, header, records)


def broken_records(text: DataFrame) -> DataFrame:
    """The records with too few or too many fields, as they stand in the file, and the values found in them."""
    return text.filter(F.col(RECORD).isNotNull()).select(F.col(RECORD).alias("record"), values_found(text))


def values_found(text: DataFrame) -> Column:
    """How many values a record has."""
    values = [F.col(c).isNotNull().cast("int") for c in text.columns if c != RECORD]
    return reduce(Column.__add__, values, F.lit(0)).alias("values_found")


def whole_records(text: DataFrame) -> DataFrame:
    # Spark refuses to read the record column alone, which counting the rows would; a hash reads the others
    others = F.hash(*[c for c in text.columns if c != RECORD])
    return text.filter(F.col(RECORD).isNull() & (others >= -(1 << 31))).drop(RECORD)


#: Quoted text takes several times the room of a columnar table, so it is packed, at the level that costs least.
_PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
#: A packed file is read by one task, so none gets larger than so many records.
FILE_RECORDS = 200_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Values keep their blanks; an empty text and NULL both come back as NULL. The files are packed with gzip."""
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    with freed_shuffles(df.sparkSession):
        df.write.mode(mode).options(**_FORM, **keep, **_PACKED, quoteAll="true", maxRecordsPerFile=FILE_RECORDS).csv(path)
