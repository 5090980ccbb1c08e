"""Compare a query with its SQL on the same tables, order aside."""

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def value(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return repr(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(value(r[i]) for i in order) for r in rows)


def differences(df, con, sql):
    """Human-readable differences, empty when both agree."""
    cur = con.execute(sql)
    want_columns, want = canonical([d[0] for d in cur.description], cur.fetchall())
    got_columns, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference:\n  spark {a}\n  sql   {b}"
    return ""
