"""Side-by-side comparison of a registered query with its SQL statement on DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


_TYPES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string", "BOOLEAN": "boolean"}


def type_diff(spark_df, con, sql: str) -> list[str]:
    """Columns whose type differs between the two engines."""
    want = {r[0]: _TYPES.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{n}: {t} != {want[n]}" for n, t in spark_df.dtypes if t != want.get(n)]


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f'{v:.9g}')
    return v


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def diff(spark_df, con, sql: str) -> str | None:
    """None when names and rows agree, otherwise a short description."""
    result = con.execute(sql)
    want_cols = [c[0] for c in result.description]
    want = result.fetchall()
    got_cols = spark_df.columns
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    got = [tuple(r) for r in spark_df.collect()]
    a, b = _rows(got_cols, got), _rows(want_cols, want)
    if a != b:
        return f"rows {len(got)} vs {len(want)}; only spark {list((a - b).items())[:3]}; only sql {list((b - a).items())[:3]}"
    return None
