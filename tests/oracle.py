"""Runs registered queries beside their SQL and compares the rows."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        if math.isnan(value) or math.isinf(value):
            return ("f", str(value))
        return ("n", repr(value))
    if isinstance(value, int):
        return ("n", repr(float(value)) if abs(value) < 2**53 else str(value))
    return ("o", str(value))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_cell(row[i]) for i in order) for row in rows)


# Column types that count as equal in the two engines.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def compare(df, con, sql):
    """None if equal, else a description of the first difference."""
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    for name, kind in df.dtypes:
        if types.get(name) != TYPES[kind]:
            return f"{name} is {kind} against {types.get(name)}"
    names, got = canonical(df.columns, rows)
    sql_names, want = canonical([d[0] for d in result.description], result.fetchall())
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{str(a)[:600]} != {str(b)[:600]}"
    return None
