"""Parent catalogs, top-down changes and dense indexes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.dedup import first_per_key
from strata.operators.skew import lookup_join
from strata.session import settle


def parent_catalog(
    children: DataFrame, parent_key: str, attributes: Sequence[str], child_key: str
) -> DataFrame:
    """Exactly one row per parent, from the first child that names it.

    Distinct attribute rows would not do: where children disagree about their
    parent, they fan out every later join.
    """
    rows = children.select(child_key, parent_key, *attributes)
    return first_per_key(rows, parent_key, [child_key]).select(parent_key, *attributes)


def propagate_parents(
    children: DataFrame,
    parents: DataFrame,
    parent_key: str,
    attributes: Sequence[str],
    method: str = "auto",
) -> DataFrame:
    """Children with their attributes replaced by those of their parent.

    A change made once per parent reaches all its children alike.  Children with
    no parent, or with one that is not among ``parents``, keep their own values.
    """
    given = {c: f"_parent_{c}" for c in attributes}
    joined = lookup_join(
        children,
        parents.select(parent_key, *attributes, F.lit(True).alias("_found")).withColumnsRenamed(given),
        [parent_key],
        how="left",
        method=method,
    )
    replaced = [
        F.when(F.col("_found"), F.col(given[c])).otherwise(F.col(c)).alias(c) if c in given else F.col(c)
        for c in children.columns
    ]
    return joined.select(*replaced)


def dense_index(ids: DataFrame, column: str, index: str = "idx") -> DataFrame:
    """The distinct values of ``column`` numbered 1..n in ascending order.

    The values are range partitioned, numbered inside their partition and
    shifted by the size of the partitions before, so no task sees them all.
    The numbered rows are made durable first: the offsets and the rows must
    come from the same partitioning even if a task is lost.
    """
    ordered = (
        ids.select(column)
        .distinct()
        .repartitionByRange(F.col(column).asc_nulls_last())
        .sortWithinPartitions(F.col(column).asc_nulls_last())
        # High bits: partition; low 33 bits: position inside the partition.
        .withColumn("_at", F.monotonically_increasing_id())
    )
    numbered = settle(
        ordered.select(
            column,
            F.shiftright("_at", 33).alias("_part"),
            F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
        )
    )
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    # One row per partition, so both the window above and the broadcast are small.
    return numbered.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_pos") + 1).alias(index), column
    )


def extend_index(known: DataFrame, ids: DataFrame, column: str, index: str = "idx") -> DataFrame:
    """``known`` numbers and, after the largest of them, numbers for the values of ``ids`` that have none.

    Numbers once given stay, so that what was stored under them (bitmaps, say) stays true; new values follow in
    ascending order without a gap.  Nulls are a value like any other.
    """
    named = known.select(F.col(column).alias("_known"))
    fresh = ids.select(column).distinct()
    fresh = fresh.join(named, F.col(column).eqNullSafe(F.col("_known")), "left_anti")
    top = known.agg(F.coalesce(F.max(index), F.lit(0)).alias("top")).scalar()
    added = dense_index(fresh, column, index).withColumn(index, F.col(index) + top)
    return known.select(index, column).unionByName(added)
