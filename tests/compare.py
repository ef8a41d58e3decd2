"""Compare a Spark result with the oracle's, types and values."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame


def oracle(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _rows(table: pa.Table) -> tuple[list, list, list]:
    names = sorted(table.column_names)
    table = table.select(names)
    types = [str(t).replace("large_", "") for t in table.schema.types]
    rows = [tuple(r.values()) for r in table.to_pylist()]
    return names, types, sorted(rows, key=repr)


def problems(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    got_names, got_types, got = _rows(result.toArrow())
    names, types, want = _rows(con.sql(sql).to_arrow_table())
    if got_names != names:
        return f"columns {got_names} != {names}"
    if got_types != types:
        wrong = [(n, g, w) for n, g, w in zip(names, got_types, types) if g != w]
        return f"types (column, spark, oracle): {wrong}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{dict(zip(names, g))} != {dict(zip(names, w))}"
    return None
