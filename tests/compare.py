"""Order-free comparison of a query with its SQL in DuckDB."""

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if v is None or v != v or isinstance(v, bool):
        return None if v is None or v != v else v
    if isinstance(v, (decimal.Decimal, int)):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.date().isoformat() if v.time() == datetime.time(0) else v.isoformat()
    return v.isoformat() if isinstance(v, datetime.date) else v


def same_rows(df, con, sql):
    names = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == names
    place = [columns.index(c) for c in names]
    want = Counter(tuple(plain(r[i]) for i in place) for r in cursor.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
    return sum(got.values())
