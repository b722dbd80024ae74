"""Runs a query on Spark and its SQL on DuckDB and compares the rows."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def compare(spark_df, con, sql):
    """Message describing the first difference, or None when the results are equal."""
    relation = con.sql(sql)
    names = sorted(spark_df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} != {sorted(relation.columns)}"
    order = [relation.columns.index(n) for n in names]
    expected = sorted((tuple(_cell(r[i]) for i in order) for r in relation.fetchall()), key=repr)
    rows = spark_df.select(*[f"`{n}`" for n in names]).collect()
    actual = sorted((tuple(_cell(c) for c in r) for r in rows), key=repr)
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e or [type(x) for x in a] != [type(x) for x in e]:
            return f"row {a} != {e}"
    return None
