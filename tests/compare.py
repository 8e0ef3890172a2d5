"""Run a query on Spark and its SQL twin on DuckDB and compare the rows exactly."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _normal(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(_normal(v) for v in row) for row in zip(*columns, strict=True)]
    return names, sorted(rows, key=repr)


def _types(table):
    kinds = {}
    for field in table.schema:
        kind = str(field.type).replace("large_", "")
        kinds[field.name] = kind
    return kinds


def differences(df, con, sql: str) -> list[str]:
    """What differs between the Spark result and the SQL result; empty if nothing does."""
    spark_table, duck_table = df.toArrow(), con.sql(sql).to_arrow_table()
    found = []
    spark_types, duck_types = _types(spark_table), _types(duck_table)
    if spark_types != duck_types:
        for name in sorted(set(spark_types) | set(duck_types)):
            if spark_types.get(name) != duck_types.get(name):
                found.append(f"type {name}: spark {spark_types.get(name)} sql {duck_types.get(name)}")
    if set(spark_types) != set(duck_types):
        return found
    _, left = _rows(spark_table)
    _, right = _rows(duck_table)
    if len(left) != len(right):
        found.append(f"rows: spark {len(left)} sql {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        found.append(f"{len(bad)} rows differ, columns {sorted(spark_types)}, first {bad[:2]}")
    return found
