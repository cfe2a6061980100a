"""Run a query and its SQL on the same tables and tell where they differ."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _type(name: str) -> str:
    name = name.lower()
    return {
        "string": "varchar", "bigint": "bigint", "int": "integer", "timestamp_ntz": "timestamp",
    }.get(name, name)


def differences(df, con, sql: str, limit: int = 3) -> list[str]:
    rel = con.sql(sql)
    cols, types = list(rel.columns), [str(t) for t in rel.types]
    found = []
    if sorted(df.columns) != sorted(cols):
        return [f"columns: {sorted(df.columns)} and {sorted(cols)}"]
    spark_types = {c: _type(t) for c, t in df.dtypes}
    for c, t in zip(cols, types, strict=True):
        if spark_types[c] != t.lower():
            found.append(f"type of {c}: {spark_types[c]} and {t.lower()}")
    order = sorted(cols)
    place = [cols.index(c) for c in order]
    ours = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    theirs = sorted((tuple(_norm(r[i]) for i in place) for r in rel.fetchall()), key=repr)
    if len(ours) != len(theirs):
        found.append(f"rows: {len(ours)} and {len(theirs)}")
    if ours != theirs:
        a, b = set(map(repr, ours)), set(map(repr, theirs))
        found += [f"only ours: {x[:300]}" for x in sorted(a - b)[:limit]]
        found += [f"only SQL: {x[:300]}" for x in sorted(b - a)[:limit]]
    return found
