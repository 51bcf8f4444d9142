"""Run a registered query and its SQL and compare the rows."""

import math
from collections import Counter

import duckdb

from cascadia.plans.views import TABLES


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql):
    """Text of the first differences, or None; also the number of rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}", 0
    rows = df.collect()
    actual = _rows(df.columns, rows)
    if actual == expected:
        return None, len(rows)
    more = list((actual - expected).items())[:3]
    less = list((expected - actual).items())[:3]
    return (
        f"{sum(actual.values())} rows, expected {sum(expected.values())}\n"
        f"only Spark: {more}\nonly SQL: {less}"
    ), len(rows)
