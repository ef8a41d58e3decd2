"""The gold rollup on disk, maintained from deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.rollup_parts import COUNTS, GROUP, PART, SUMS, fold_parts, revenue_of_parts, revenue_parts
from strata.session import settle


class RevenueLedger:
    """Parts and gold rows under one folder, both partitioned by month.

    ``parts/kind=delta/batch=<n>/order_month=<m>`` holds what batch n changed.  ``parts/kind=base/batch=<n>`` holds all
    parts up to and with batch n; a month counts from its last base on.  ``gold/order_month=<m>`` is written anew, by
    dynamic partition overwrite, for the months that a batch touched and for no other.

    Every step may be run again after a failure: a batch's delta replaces itself, gold follows from the parts.
    Batches have ascending numbers and one writer.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self._parts = f"{root.rstrip('/')}/parts"
        self._gold = f"{root.rstrip('/')}/gold"

    # -- reading ---------------------------------------------------------
    def _stored(self) -> DataFrame:
        return self.spark.read.option("basePath", self._parts).parquet(self._parts)

    def parts(self, months: list | None = None) -> DataFrame:
        """Parts of the present orders that are not folded yet; of some months only, other months are not read."""
        rows = self._stored()
        if months is not None:
            rows = rows.filter(F.col("order_month").isin(months))
        base = F.col("kind") == "base"
        # Partition columns only: one row per month.
        since = rows.filter(base).groupBy("order_month").agg(F.max("batch").alias("_since"))
        rows = rows.join(since, "order_month", "left")
        fresh = F.coalesce(F.col("batch") > F.col("_since"), F.lit(True))
        return rows.filter(F.when(base, F.col("batch") == F.col("_since")).otherwise(fresh)).select(*PART, *COUNTS, *SUMS)

    def read(self) -> DataFrame:
        """The gold rows."""
        return self._all().filter(F.col("order_count") > 0)

    def _all(self) -> DataFrame:
        rows = self.spark.read.parquet(self._gold)
        return rows.select(*GROUP, *[c for c in rows.columns if c not in GROUP])

    # -- writing ---------------------------------------------------------
    def load(self, orders: DataFrame, dimension: DataFrame, generated_at=None) -> None:
        """All parts and gold rows anew, as batch 0."""
        folder = f"{self._parts}/kind=base/batch=0"
        _by_month(revenue_parts(orders, dimension)).mode("overwrite").partitionBy("order_month").parquet(folder)
        gold = revenue_of_parts(fold_parts(self.parts()), generated_at)
        _by_month(gold).mode("overwrite").partitionBy("order_month").parquet(self._gold)

    def apply(self, batch: int, delta: DataFrame, generated_at=None) -> list:
        """Store the delta of a batch and write the months that it touched; returns these."""
        if batch < 1:
            raise ValueError("batches count from 1")
        folder = f"{self._parts}/kind=delta/batch={batch}"
        _by_month(delta).mode("overwrite").partitionBy("order_month").parquet(folder)
        mine = self._stored().filter((F.col("kind") == "delta") & (F.col("batch") == batch))
        # As many values as a batch touches months.
        months = sorted(r["order_month"] for r in mine.select("order_month").distinct().collect())
        if months:
            groups = mine.select(*GROUP).distinct()
            same = [F.col(f"g.{c}").eqNullSafe(F.col(f"t.{c}")) for c in GROUP]
            present = self._all().filter(F.col("order_month").isin(months)).alias("g")
            kept = present.join(groups.alias("t"), same, "left_anti")
            own = self.parts(months).alias("g").join(groups.alias("t"), same, "left_semi")
            # A group that lost its last order stays, as a month without rows would keep its old ones.
            new = revenue_of_parts(fold_parts(own), generated_at, keep_empty=True)
            gone = groups.alias("t").join(new.alias("g"), same, "left_anti").withColumn("order_count", F.lit(0))
            rows = kept.unionByName(new, allowMissingColumns=True).unionByName(gone, allowMissingColumns=True)
            self._overwrite_months(rows.select(*present.columns), self._gold)
        return months

    def fold(self, batch: int) -> None:
        """Make one base of everything up to ``batch``, the last one applied, so that later reads open fewer files."""
        folded = fold_parts(self.parts())
        folder = f"{self._parts}/kind=base/batch={batch}"
        _by_month(settle(folded)).mode("overwrite").partitionBy("order_month").parquet(folder)

    @staticmethod
    def _overwrite_months(rows: DataFrame, path: str) -> None:
        """Replace the months that ``rows`` has.  Spark stages the rows before it replaces a folder, so they may come
        from the same path."""
        writer = _by_month(rows).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("order_month").parquet(path)


def _by_month(rows: DataFrame):
    """Rows of a month together, a large month in several tasks."""
    return rows.hint("rebalance", "order_month").write


