"""Relational tables over JDBC.

Reads are split on a numeric column, writes are one connection per partition.
The driver jar and the connection details come from the caller.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from hemline.sources.delimited import write_csv
from hemline.sources.serving import SERVING, to_serving

# Source table -> landed CSV folder.
LANDED_TABLES = {
    "Customers": "customers",
    "Discounts": "discounts",
    "Employees": "employees",
    "Products": "products",
    "Stores": "stores",
    "Transactions": "transactions",
}


@dataclass(frozen=True)
class Database:
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    schema: str = ""

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}" if self.schema else name


def split_options(column: str, lower: int, upper: int, parts: int) -> dict[str, str]:
    """Range options of a parallel read; rows outside the range are still read."""
    if parts < 1 or upper < lower:
        raise ValueError("a split needs at least one part and lower <= upper")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(parts),
    }


def read_jdbc(spark: SparkSession, db: Database, name: str,
              split: dict[str, str] | None = None, fetch_size: int = 10_000) -> DataFrame:
    reader = spark.read.format("jdbc").options(**db.properties)
    reader = reader.option("url", db.url).option("dbtable", db.table(name))
    return reader.option("fetchsize", fetch_size).options(**(split or {})).load()


def write_jdbc(df: DataFrame, db: Database, name: str, mode: str = "append",
               connections: int = 16, batch_size: int = 10_000) -> None:
    """Insert rows; ``overwrite`` truncates first, so a re-run adds no duplicates."""
    (
        df.write.format("jdbc").options(**db.properties)
        .option("url", db.url).option("dbtable", db.table(name))
        .option("numPartitions", connections).option("batchsize", batch_size)
        .option("truncate", "true").mode(mode).save()
    )


def land_tables(spark: SparkSession, db: Database, bronze_root: str,
                splits: dict[str, dict[str, str]]) -> None:
    """Copy every source table to a CSV folder.

    The transactions need a split: they would come over one connection without.
    """
    unsplit = [n for n, folder in LANDED_TABLES.items() if folder == "transactions" and n not in splits]
    if unsplit:
        raise ValueError(f"pass split_options for {', '.join(unsplit)}")
    for name, folder in LANDED_TABLES.items():
        write_csv(read_jdbc(spark, db, name, splits.get(name)), f"{bronze_root}/{folder}")


def serve_table(gold: DataFrame, db: Database, table: str, target: str,
                mode: str = "append") -> None:
    """Insert one gold table in its serving layout, columns by name."""
    write_jdbc(to_serving(gold, table), db, target, mode)


def serve_all(tables: dict[str, DataFrame], db: Database, targets: dict[str, str],
              mode: str = "append") -> None:
    """Insert all gold tables; ``targets`` names the database table of each."""
    missing = sorted(set(SERVING) - set(tables)) + sorted(set(SERVING) - set(targets))
    if missing:
        raise ValueError(f"no table or target for {', '.join(missing)}")
    for name in SERVING:
        serve_table(tables[name], db, name, targets[name], mode)
