"""Compare a query with its SQL twin in DuckDB, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (v + 0.0 if v else 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def kind_of(t: str) -> str:
    t = t.lower()
    for prefix, kind in (
        ("double", "double"), ("float", "double"), ("decimal", "decimal"), ("bigint", "bigint"), ("hugeint", "hugeint"),
        ("int", "int"), ("varchar", "string"), ("string", "string"), ("date", "date"), ("bool", "bool"),
        ("timestamp", "timestamp"),
    ):
        if t.startswith(prefix):
            return kind
    return t


def compare(df, sql: str, con) -> str | None:
    """None when equal, else a short description of the difference."""
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    types = {c[0]: kind_of(str(c[1])) for c in res.description}
    expected = rows_of(names, res.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    odd = {c: (t, types[c]) for c, t in ((c, kind_of(t)) for c, t in df.dtypes) if t != types[c]}
    n_got, n_exp = sum(got.values()), sum(expected.values())
    if got != expected:
        a, b = list((got - expected).items())[:2], list((expected - got).items())[:2]
        n = sum((got - expected).values())
        return f"rows {n_got} vs {n_exp}, {n} differ: spark {a} sql {b} (columns {sorted(names)}) types {odd}"
    if odd:
        return f"types {odd} (values equal, {n_got} rows)"
    if n_got == 0:
        return "no rows"
    return None
