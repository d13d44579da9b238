"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else round(number, 6)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql):
    """Text of what differs, or None."""
    mine = [tuple(r) for r in spark_df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    a, b = bag(spark_df.columns, mine), bag(names, theirs)
    if a == b:
        return None
    only = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
    return f"values differ in {sum(x != y for x, y in zip(a, b))}: {sorted(names)} {only}"
