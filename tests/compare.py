"""Spark result against DuckDB result: columns by name, rows in any order, values."""

from __future__ import annotations

import glob
import os
from collections import Counter


def duck(d: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(os.path.join(d, "*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return str(value) if value is not None and not isinstance(value, (int, str, bool)) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str):
    """None when equal, else what differs."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    want = rows_of(names, result.fetchall())
    got = rows_of(spark_df.columns, spark_df.collect())
    twin = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}
    types = {n: (t, twin.get(kinds[n], kinds[n])) for n, t in spark_df.dtypes if twin.get(kinds[n], kinds[n]) != t}
    if types:
        return f"types (spark, duckdb) {types}"
    if got != want:
        missing, extra = want - got, got - want
        return f"{sum(got.values())} rows vs {sum(want.values())}; missing {list(missing)[:2]}; extra {list(extra)[:2]}"
    return None
