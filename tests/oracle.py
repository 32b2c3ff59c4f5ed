"""Compares a query with its SQL in DuckDB, as sets of rows with columns by name."""

import math
from pathlib import Path

import duckdb


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "as_tuple"):
        return float(value)
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value


def same_rows(frame, sql, root):
    con = duckdb.connect()
    for path in Path(root).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    mine = sorted(repr([_plain(r[c]) for c in sorted(names)]) for r in frame.collect())
    theirs = sorted(repr([_plain(r[names.index(c)]) for c in sorted(names)]) for r in cursor.fetchall())
    assert mine == theirs
