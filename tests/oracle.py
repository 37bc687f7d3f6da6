"""Comparison of a query with its SQL, run by DuckDB on the same tables."""

import math
import os
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else int(v) if v == int(v) and abs(v) < 1e15 else round(v, 6)
    return v


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in values), key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def differences(spark, sf_dir, query, sql):
    """What differs, as text; '' if nothing does."""
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = connect(sf_dir).execute(sql)
    want = rows([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    if got[1] != want[1]:
        a, b = [r for r in got[1] if r not in set(want[1])][:3], [r for r in want[1] if r not in set(got[1])][:3]
        return f"{len(got[1])} and {len(want[1])} rows; only here {str(a)[:400]}; only in SQL {str(b)[:400]}"
    return ""
