"""Compare a registered query with its SQL in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(r[i] for i in order)) for r in rows)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cur = con.execute(sql)
    return canonical([d[0] for d in cur.description], cur.fetchall())


def difference(mine, theirs) -> str | None:
    """None when equal, else what differs."""
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if mine[1] == theirs[1]:
        return None
    a, z = set(mine[1]), set(theirs[1])
    return f"rows {len(mine[1])} vs {len(theirs[1])}; only spark {sorted(a - z)[:3]}; only sql {sorted(z - a)[:3]}"
