"""Compare a Spark result with DuckDB: column names, types, row count and values."""

import glob
import math
import os

import duckdb

# DuckDB type -> Spark type.
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
         "TIMESTAMP": "timestamp_ntz", "DATE": "date", "BOOLEAN": "boolean"}


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS FROM '{path}'")
    return con


def _key(value):
    return (value is not None, str(value))


def _rows(rows, order):
    ordered = (tuple(row[i] for i in order) for row in rows)
    return sorted(ordered, key=lambda row: [_key(v) for v in row])


def differences(df, con, sql):
    """A list of findings, empty when the two agree."""
    relation = con.sql(sql)
    names, types = df.columns, dict(df.dtypes)
    if sorted(names) != sorted(relation.columns):
        return [f"columns {sorted(names)} / {sorted(relation.columns)}"]
    found = []
    for name, kind in zip(relation.columns, relation.types):
        if types[name] != TYPES.get(str(kind), str(kind)):
            found.append(f"type of {name}: {types[name]} / {kind}")
    left = _rows(df.collect(), [names.index(n) for n in sorted(names)])
    right = _rows(relation.fetchall(), [relation.columns.index(n) for n in sorted(names)])
    if len(left) != len(right):
        return [*found, f"rows {len(left)} / {len(right)}"]
    for a, b in zip(left, right):
        if a != b and not all(x == y or (isinstance(x, float) and isinstance(y, float)
                                         and math.isnan(x) and math.isnan(y))
                              for x, y in zip(a, b)):
            return [*found, f"values {a} / {b}"]
    return found
