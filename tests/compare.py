"""Compare a Spark result with its DuckDB oracle, value for value."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

SMALL = "/root/testdata/sf0.001"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, Decimal)):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def kinds(types: dict[str, str]) -> dict[str, str]:
    """Column types reduced to families both engines name."""
    def family(t: str) -> str:
        t = t.lower()
        if t in ("tinyint", "smallint", "int", "integer", "bigint", "hugeint"):
            return t.replace("integer", "int")
        if t in ("string", "varchar"):
            return "string"
        return t.replace("timestamp_ntz", "timestamp")

    return {c: family(t) for c, t in types.items()}


def differences(result, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[str]]:
    """(errors, type notes): errors are differing columns or rows."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    types = {d[0]: str(d[1]) for d in expected.description}
    want = rows_of(names, expected.fetchall())
    got = rows_of(result.columns, result.collect())
    errors = []
    if sorted(names) != sorted(result.columns):
        errors.append(f"columns {sorted(result.columns)} != {sorted(names)}")
    elif want != got:
        only_got, only_want = got - want, want - got
        errors.append(
            f"rows {sum(got.values())} vs {sum(want.values())}; {sum(only_got.values())} differ, "
            f"e.g. {list(only_got)[:2]} vs {list(only_want)[:2]}"
        )
    a, b = kinds(dict(result.dtypes)), kinds(types)
    notes = [f"{c}: {a[c]} vs {b.get(c)}" for c in a if a[c] != b.get(c)]
    return errors, notes
