"""Run a registered query and its SQL side by side and compare the rows."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (v + 0.0 if abs(v) < 1e15 else v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _sorted(rows):
    return sorted(rows, key=lambda t: tuple((x is None, type(x).__name__, x) for x in t))


def spark_rows(df):
    names = sorted(df.columns)
    return names, _sorted([tuple(_cell(row[n]) for n in names) for row in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    found = [d[0] for d in cur.description]
    names = sorted(found)
    at = [found.index(n) for n in names]
    return names, _sorted([tuple(_cell(row[i]) for i in at) for row in cur.fetchall()])


def differences(df, con, sql, limit: int = 3) -> list[str]:
    names, got = spark_rows(df)
    expected_names, want = sql_rows(con, sql)
    if names != expected_names:
        return [f"columns {sorted(set(names) ^ set(expected_names))}"]
    out = []
    if len(got) != len(want):
        out.append(f"rows {len(got)} vs {len(want)}")
    for a, b in zip(got, want):
        bad = [(n, x, y) for n, x, y in zip(names, a, b) if type(x) is not type(y) or x != y]
        if bad:
            out.append(f"{bad}")
            if len(out) >= limit:
                break
    return out
