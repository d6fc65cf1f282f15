"""Run a registered query and its SQL and compare the two results as multisets."""

from __future__ import annotations

import glob
import math
import os

import duckdb

from oracles import ORACLES
from registry import QUERIES


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f'CREATE VIEW "{name}" AS SELECT * FROM read_parquet(\'{path}\')')
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def cell(v):
        return (v is None, round(v, 6) + 0.0 if isinstance(v, float) and math.isfinite(v) else v)
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, key: str) -> int:
    df = QUERIES[key](spark, sf_dir)
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLES[key])
    right = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert left[0] == right[0]
    assert len(left[1]) == len(right[1]), (key, len(left[1]), len(right[1]))
    for got, want in zip(left[1], right[1]):
        assert got == want, (key, got, want)
    return len(left[1])
