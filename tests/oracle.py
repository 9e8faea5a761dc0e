"""Compare a Spark result with DuckDB SQL over the same parquet tables."""

import math
from pathlib import Path

import duckdb

from basketry.sources.tables import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, float):
        return (1, repr(v))
    if isinstance(v, (list, tuple)):
        return (2, repr([_norm(x) for x in v]))
    return (1, str(v))


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    res = con.execute(sql)
    return canonical([d[0] for d in res.description], res.fetchall())
