"""Small helpers for hand-made tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[tuple]:
    """All rows as tuples, in one order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(a: DataFrame, b: DataFrame) -> None:
    assert a.columns == b.columns
    assert rows(a) == rows(b)


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df: DataFrame) -> str:
    """The plan after the run, with what adaptive execution made of it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def write_file(folder, name: str, header: str, *lines: str) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
