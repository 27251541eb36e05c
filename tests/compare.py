"""Rows of a Spark query against rows of its SQL twin, in a form that does not depend on order or engine types."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        if math.isnan(x):
            return "nan"
        return f"{x:.6g}" if x != int(x) or abs(x) > 1e15 else str(int(x))
    if isinstance(x, bool):
        return str(x).lower()
    if isinstance(x, datetime.datetime):
        return x.strftime("%Y-%m-%d %H:%M:%S.%f")
    return "null" if x is None else str(x)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(tuple(map(plain, r)) for r in df.select(*names).collect())


def duck_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        if Path(sf_dir, f"{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in got.fetchall())
