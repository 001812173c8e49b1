"""Compare a Spark result with a DuckDB statement: columns, types and every row."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# DuckDB type behind each Spark type.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(folder) / f"{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def differences(df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    columns = sorted(rel.columns)
    out = []
    if sorted(df.columns) != columns:
        return [f"columns {sorted(df.columns)} vs {columns}"]
    spark_types = dict(df.dtypes)
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    for c in columns:
        if TYPES.get(spark_types[c]) != duck_types[c]:
            out.append(f"type of {c}: {spark_types[c]} vs {duck_types[c]}")
    left = Counter(tuple(r) for r in df.select(*columns).collect())
    right = Counter(con.sql(f"select {', '.join(columns)} from ({sql})").fetchall())
    if sum(left.values()) != sum(right.values()):
        out.append(f"rows {sum(left.values())} vs {sum(right.values())}")
    for name, extra in (("spark only", left - right), ("duckdb only", right - left)):
        for row in list(extra)[:3]:
            out.append(f"{name}: {dict(zip(columns, row))}")
    if not left:
        out.append("no rows")
    return out
