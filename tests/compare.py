"""Compare Spark results with SQL results, whatever the order of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """In-process database with the test tables as views."""
    db = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            db.execute(f"create view {table} as select * from '{path}'")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if hasattr(value, "asDict"):
        return tuple(_cell(v) for v in value)
    if isinstance(value, dict):
        return tuple(_cell(v) for v in value.values())
    return value


def rows_of(columns: list[str], rows) -> Counter:
    """Rows as a bag, columns sorted by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(frame, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    answer = db.execute(sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    expected = rows_of(names, answer.fetchall())
    actual = rows_of(frame.columns, frame.collect())
    if actual == expected:
        return None
    return (
        f"{actual.total()} rows against {expected.total()}; "
        f"only here {list((actual - expected).items())[:3]}, "
        f"only there {list((expected - actual).items())[:3]}"
    )
