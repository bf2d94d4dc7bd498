"""Compare a Spark result with DuckDB on the same parquet files."""

from __future__ import annotations

import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame

KINDS = {
    "bigint": "int",
    "int": "int",
    "smallint": "int",
    "tinyint": "int",
    "double": "float",
    "float": "float",
    "string": "text",
    "date": "date",
    "boolean": "bool",
    "BIGINT": "int",
    "INTEGER": "int",
    "DOUBLE": "float",
    "FLOAT": "float",
    "VARCHAR": "text",
    "DATE": "date",
    "BOOLEAN": "bool",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    return repr(v)


def differences(con: duckdb.DuckDBPyConnection, sql: str, df: DataFrame) -> list[str]:
    """Empty when names, kinds, row count and values agree."""
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, (KINDS.get(str(t), str(t)) for t in rel.types)))
    ours = {c: KINDS.get(t, t) for c, t in df.dtypes}
    out = []
    if set(theirs) != set(ours):
        return [f"columns differ: only ours {sorted(set(ours) - set(theirs))}, only SQL {sorted(set(theirs) - set(ours))}"]
    bad = {c: (ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]}
    if bad:
        out.append(f"types differ (ours, SQL): {bad}")
    names = sorted(ours)
    a = sorted(tuple(_norm(r[c]) for c in names) for r in df.collect())
    order = [rel.columns.index(c) for c in names]
    b = sorted(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())
    if len(a) != len(b):
        out.append(f"rows differ: ours {len(a)}, SQL {len(b)}")
    if a != b:
        sa, sb = set(a), set(b)
        only_a, only_b = sorted(sa - sb), sorted(sb - sa)
        out.append(f"values differ: {len(only_a)} rows only ours, {len(only_b)} only SQL")
        for x, y in list(zip(only_a, only_b))[:2]:
            out.append("  " + str({n: (i, j) for n, i, j in zip(names, x, y) if i != j or n == names[0]}))
        if not only_a or not only_b:
            out.append("  " + str((only_a or only_b)[:2]))
    return out
