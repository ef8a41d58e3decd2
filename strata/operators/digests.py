"""Two states of a table compared by digests of ranges of its keys, on two levels.

A key's hash says which of ``COARSE`` ranges it is in, and which of the ``FINE`` ranges inside it.  A range's digest adds up
hashes of its rows, so it is made in one pass without a shuffle of rows, and coarse digests follow from fine ones.
Only ranges whose digests differ can hold a difference, and only their rows are compared.  A state that is stored by
coarse range, with its digests beside it, is not even read elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import differs
from strata.operators.changes import diff_snapshots
from strata.schema import OP

COARSE, FINE = 256, 256
_DIGEST = ("n", "one", "two")


def _ranges(key: str, kind: str) -> tuple[Column, Column]:
    """The coarse and the fine range of a key; ``kind`` is its type, as a hash depends on it."""
    h = F.xxhash64(F.lit("range"), F.col(key).cast(kind))
    coarse = F.pmod(h, F.lit(COARSE)).cast("int")
    return coarse, F.pmod(F.shiftrightunsigned(h, 32), F.lit(FINE)).cast("int")


def _kind(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def range_digests(df: DataFrame, key: str, compare: Sequence[str] | None = None) -> DataFrame:
    """``coarse``, ``fine``, how many rows the range has, and two independent digests of the compared columns."""
    columns = sorted(compare or [c for c in df.columns if c != key])
    coarse, fine = _ranges(key, _kind(df, key))
    # xxhash64 passes nulls over, so that a value could change places with a null beside it: they are told apart.
    absent = F.concat_ws("", *[F.col(c).isNull().cast("int").cast("string") for c in columns])
    one, two = (F.xxhash64(F.lit(salt), key, absent, *columns) for salt in (1, 2))
    rows = df.select(coarse.alias("coarse"), fine.alias("fine"), one.alias("one"), two.alias("two"))
    return rows.groupBy("coarse", "fine").agg(
        F.count("*").alias("n"), F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two")
    )


def coarse_digests(digests: DataFrame) -> DataFrame:
    return digests.groupBy("coarse").agg(
        F.sum("n").alias("n"), F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two")
    )


def _unequal(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    old = before.withColumnsRenamed({c: f"old_{c}" for c in _DIGEST})
    joined = old.join(after, by, "full_outer")
    wrong = F.lit(False)
    for c in _DIGEST:
        wrong = wrong | differs(f"old_{c}", c)
    return joined.filter(wrong).select(*by)


def differing_ranges(before: DataFrame, after: DataFrame) -> DataFrame:
    """``coarse`` and ``fine`` of the ranges whose digests differ: whole coarse ranges are settled first."""
    coarse = _unequal(coarse_digests(before), coarse_digests(after), ["coarse"])
    old, new = (d.join(coarse, "coarse", "left_semi") for d in (before, after))
    return _unequal(old, new, ["coarse", "fine"])


def diff_by_digests(
    before: DataFrame,
    after: DataFrame,
    key: str,
    compare: Sequence[str] | None = None,
    op: str = OP,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """``diff_snapshots``, with only the rows of differing ranges brought together.

    ``ranges`` are those of ``differing_ranges`` where digests are known; otherwise both sides are read once for
    their digests, without a shuffle of rows.  Both keys have one type.
    """
    if _kind(before, key) != _kind(after, key):
        raise ValueError("keys of two types have no common ranges")
    if ranges is None:
        ranges = differing_ranges(range_digests(before, key, compare), range_digests(after, key, compare))
    # No more than COARSE * FINE rows.
    ranges = F.broadcast(ranges.withColumnsRenamed({"coarse": "_coarse", "fine": "_fine"}))

    def suspected(df: DataFrame) -> DataFrame:
        coarse, fine = _ranges(key, _kind(df, key))
        return df.join(ranges, (coarse == F.col("_coarse")) & (fine == F.col("_fine")), "left_semi")

    return diff_snapshots(suspected(before), suspected(after), key, compare, op)


class RangedSnapshot:
    """A snapshot stored by coarse range, with its digests."""

    def __init__(self, spark: SparkSession, path: str, key: str, compare: Sequence[str] | None = None):
        self.spark, self.path, self.key, self.compare = spark, path.rstrip("/"), key, compare

    def write(self, df: DataFrame) -> None:
        """Replace the snapshot.  The digests come last, from what was stored, so that they never run ahead of it."""
        coarse, _ = _ranges(self.key, _kind(df, self.key))
        rows = df.withColumn("_coarse", coarse).hint("rebalance", "_coarse")
        rows.write.mode("overwrite").partitionBy("_coarse").parquet(f"{self.path}/rows")
        digests = range_digests(self.read(), self.key, self.compare)
        digests.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/digests")  # at most COARSE * FINE rows

    def digests(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/digests")

    def read(self, coarse: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some coarse ranges: other folders are not read."""
        rows = self.spark.read.parquet(f"{self.path}/rows")
        return (rows if coarse is None else rows.filter(F.col("_coarse").isin(list(coarse)))).drop("_coarse")


def diff_stored(before: RangedSnapshot, after: RangedSnapshot, op: str = OP) -> DataFrame:
    """The change batch between two stored snapshots; reads the coarse ranges that differ and no others."""
    ranges = differing_ranges(before.digests(), after.digests())
    coarse = sorted(r["coarse"] for r in ranges.select("coarse").distinct().collect())  # at most COARSE numbers
    return diff_by_digests(before.read(coarse), after.read(coarse), before.key, before.compare, op, ranges)
