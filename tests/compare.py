"""Compare a query with its SQL twin the way the driver does: columns by name, rows as a bag."""

from __future__ import annotations

import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return bag(df.columns, [tuple(r) for r in df.collect()])


def duck_bag(con, sql: str):
    con.execute(sql)
    columns = [d[0] for d in con.description]
    return bag(columns, con.fetchall())


def duck_types(con, sql: str) -> dict[str, str]:
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}


# Spark type names and what DuckDB calls them.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def type_differences(df, types: dict[str, str]) -> list[str]:
    return [
        f"{n}: {t} / {types.get(n)}" for n, t in df.dtypes if SAME_TYPE.get(t) != types.get(n)
    ]
