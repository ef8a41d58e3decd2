"""Column expressions shared by the operators; all run inside codegen."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1900-01-01 00:00:00"  # first versions open here, so that old facts find an owner


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: str | Column, how: str | None) -> Column:
    """Blank-trimmed text, optionally folded to one case."""
    c = _col(c)
    if how is None:
        return c
    trimmed = F.trim(c)
    if how == "trim":
        return trimmed
    if how == "lower":
        return F.lower(trimmed)
    if how == "upper":
        return F.upper(trimmed)
    raise ValueError(f"unknown text rule {how!r}")


def instant(value: str | datetime | date | Column, zoned: bool = False) -> Column:
    """A batch time as a literal.

    One fixed value per batch: a ``current_timestamp()`` in a lazy plan would be
    evaluated again by every action and leave gaps between versions.
    """
    literal = value if isinstance(value, Column) else F.lit(value)
    return literal.cast("timestamp" if zoned else "timestamp_ntz")


def change_hash(columns: Sequence[str], null_token: str | None = None) -> Column:
    """Digest of the tracked columns.

    ``concat_ws`` skips nulls, so (null, x) and (x, null) digest alike; pass a
    ``null_token`` where that matters.
    """
    parts = [F.col(c).cast("string") for c in columns]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.md5(F.concat_ws("|", *parts))


def version_key(key: str, hash_column: str, valid_from: str) -> Column:
    """Surrogate key of one version: natural key, content digest and start."""
    return F.md5(
        F.concat_ws(
            "|",
            F.col(key).cast("string"),
            F.col(hash_column),
            F.col(valid_from).cast("timestamp_ntz").cast("string"),
        )
    )


def month_of(c: str | Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_col(c), "MM")


def slot_of(c: str | Column, slot: str) -> Column:
    """First day of the calendar slot (year, quarter, month, week or day), in no time zone."""
    day = _col(c).cast("date")
    return day if slot == "day" else F.trunc(day, slot)


def differs(a: str | Column, b: str | Column) -> Column:
    """Null-safe inequality."""
    return ~_col(a).eqNullSafe(_col(b))


def tuple_differs(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Null-safe inequality of two column tuples."""
    return ~F.struct(*a).eqNullSafe(F.struct(*b))


def draw(*columns: str | Column, salt: int = 0, buckets: int = 10_000) -> Column:
    """A repeatable draw in [0, buckets) from the row's own values.

    Unlike ``rand()`` it gives the same value when a lost task runs again.
    """
    return F.pmod(F.xxhash64(*[_col(c) for c in columns], F.lit(salt)), F.lit(buckets))
