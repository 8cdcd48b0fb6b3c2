"""Compare a Spark result with DuckDB SQL as multisets of rows.

Columns are matched by name; values are normalised (timestamps to ISO text,
floats rounded to 9 significant digits, NaN to None) before counting.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def spark_rows(df) -> tuple[list[str], Counter]:
    cols = sorted(df.columns)
    rows = df.select(*cols).collect()
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in rows)


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in data)


def compare(df, con, sql: str) -> tuple[bool, str]:
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(con, sql)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if s_rows != d_rows:
        only_s = list((s_rows - d_rows).elements())[:3]
        only_d = list((d_rows - s_rows).elements())[:3]
        return False, (f"rows differ: spark={sum(s_rows.values())} duck={sum(d_rows.values())} "
                       f"only_spark={only_s} only_duck={only_d}")
    return True, f"{sum(s_rows.values())} rows"
