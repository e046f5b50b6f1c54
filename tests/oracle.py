"""Compare a Spark result with DuckDB SQL over the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from framewright.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("null",)
        return ("num", v)
    if isinstance(v, decimal.Decimal):
        return ("num", float(v))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", float(v)) if abs(v) < 2**53 else ("int", v)
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None))
    if isinstance(v, dt.date):
        return ("date", v)
    if isinstance(v, (list, tuple)):
        return ("list", tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return ("map", tuple(sorted((str(k), _norm(x)) for k, x in v.items())))
    return ("str", str(v))


def spark_rows(df):
    cols = sorted(df.columns)
    out = []
    for r in df.collect():
        d = r.asDict(recursive=True)
        out.append(tuple(_norm(d[c]) for c in cols))
    return cols, out


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    rows = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(df, con, sql):
    scols, srows = spark_rows(df)
    dcols, drows = duck_rows(con, sql)
    assert scols == dcols, f"columns differ: spark={scols} duck={dcols}"
    assert len(srows) == len(drows), f"row counts differ: spark={len(srows)} duck={len(drows)}"
    s_sorted, d_sorted = sorted(srows, key=repr), sorted(drows, key=repr)
    for a, b in zip(s_sorted, d_sorted):
        assert a == b, f"first differing row:\nspark={a}\nduck ={b}"
