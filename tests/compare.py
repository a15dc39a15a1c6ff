"""Exact comparison of a query's rows with those of its SQL in DuckDB."""

import glob
import os

import duckdb


def connect(folder):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _sort_key(row):
    return [(v is None, str(type(v)), v if v is not None else 0) for v in row]


def _normal(value):
    """Floats as text, so that a negative zero or NaN shows."""
    return repr(value) if isinstance(value, float) else value


# DuckDB's names of the types the queries return
TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def spark_types(df):
    return {name: TYPE_NAMES.get(kind, kind) for name, kind in df.dtypes}


def sql_types(connection, sql):
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    return {row[0]: row[1] for row in described}


def ordered_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_normal(r[i]) for i in order] for r in rows), key=_sort_key)


def spark_rows(df):
    return sorted(df.columns), ordered_rows(df.columns, df.collect())


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), ordered_rows(names, cursor.fetchall())


def first_difference(got, expected):
    for a, b in zip(got, expected):
        if a != b:
            return a, b
    return None
