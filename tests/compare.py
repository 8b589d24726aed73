"""Row-by-row comparison of a registered query with its SQL."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return repr(value)
    return f"{type(value).__name__}:{value}"


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_frame, con, sql: str) -> dict:
    """Empty when names and all rows agree."""
    cursor = con.execute(sql)
    sql_names = [d[0] for d in cursor.description]
    sql_rows = cursor.fetchall()
    names = spark_frame.columns
    if sorted(names) != sorted(sql_names):
        return {"only_spark": sorted(set(names) - set(sql_names)), "only_sql": sorted(set(sql_names) - set(names))}
    spark_rows = [tuple(row) for row in spark_frame.collect()]
    left, right = _bag(names, spark_rows), _bag(sql_names, sql_rows)
    if left == right:
        return {}
    more, less = left - right, right - left
    return {
        "rows": (len(spark_rows), len(sql_rows)),
        "columns": sorted(names),
        "only_spark": sum(more.values()),
        "only_sql": sum(less.values()),
        "spark_sample": [sorted(more)[i] for i in range(min(2, len(more)))],
        "sql_sample": [sorted(less)[i] for i in range(min(2, len(less)))],
    }
