"""The gold rollup kept up to date by its changes.

Parts are the rollup one step before its last: counts and sums per group and customer, so that a group's distinct
customers are its parts with orders.  All measures add up, and an order that changes or changes hands is taken out with
the sign -1 and put in again with +1.  Folding the parts of the first load and of all deltas gives the parts of the
present orders, whatever was updated, deleted, inserted or attributed anew in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import instant, month_of
from strata.operators.attribution import point_in_time_join
from strata.operators.history import DEFAULT, ControlColumns
from strata.operators.rollup import OWNER

GROUP = (*OWNER, "order_month")
PART = (*GROUP, "customer_id")
STATUSES = ("paid", "pending", "refunded")
#: Orders with an amount are counted beside the sums, as a sum over none of them is null.
COUNTS = ("orders", *[f"{s}_orders" for s in STATUSES], *[f"{s}_amounts" for s in STATUSES])
SUMS = tuple(f"{s}_sum" for s in STATUSES)
_EXACT = "decimal(38,2)"


def revenue_parts(orders: DataFrame, dimension: DataFrame, sign: int = 1, method: str = "auto") -> DataFrame:
    """One row per group and customer, its counts and sums multiplied by ``sign``."""
    facts = orders.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
    facts = facts.select("order_id", "customer_id", "order_date", "amount", "status")
    rows = point_in_time_join(facts, dimension, "customer_id", "order_date", OWNER, method=method)
    is_ = {s: F.col("status") == s for s in STATUSES}
    given = {s: is_[s] & F.col("amount").isNotNull() for s in STATUSES}
    measures = [F.count("*")] + [F.count_if(is_[s]) for s in STATUSES] + [F.count_if(given[s]) for s in STATUSES]
    total = [F.coalesce(F.sum(F.when(is_[s], F.col("amount"))), F.lit(0)).cast(_EXACT) for s in STATUSES]
    parts = rows.withColumn("order_month", month_of("order_date")).groupBy(*PART)
    return parts.agg(*[(m * sign).alias(c) for m, c in zip(measures + total, COUNTS + SUMS)])


def fold_parts(parts: DataFrame) -> DataFrame:
    """Parts added up; what cancels out leaves no row."""
    added = parts.groupBy(*PART).agg(*[F.sum(c).cast("bigint" if c in COUNTS else _EXACT).alias(c) for c in COUNTS + SUMS])
    some = F.lit(False)
    for c in COUNTS + SUMS:
        some = some | (F.col(c) != 0)
    return added.filter(some)


def moved_since(
    dimension: DataFrame, ts, key: str = "customer_id", names: ControlColumns = DEFAULT
) -> DataFrame:
    """Keys with a version that began or ended at ``ts`` or later, and the first instant ``since`` which one did.

    Facts before that instant are attributed as ever.
    """
    edges = F.explode(F.array(names.valid_from, names.valid_to))
    late = dimension.select(key, edges.alias("since")).filter(F.col("since") >= instant(ts))
    return late.groupBy(key).agg(F.min("since").alias("since"))


def _touched(orders: DataFrame, keys: DataFrame | None, moved: DataFrame | None) -> DataFrame:
    """The orders whose key is listed, and those of moved customers from that instant on."""
    wanted, rows = F.lit(False), orders
    if keys is not None:
        rows = rows.join(keys.select("order_id").distinct().withColumn("_listed", F.lit(True)), "order_id", "left")
        wanted = wanted | F.col("_listed").isNotNull()
    if moved is not None:
        rows = rows.join(moved.select("customer_id", F.col("since").alias("_since")), "customer_id", "left")
        wanted = wanted | F.coalesce(F.col("order_date").cast("timestamp_ntz") >= F.col("_since"), F.lit(False))
    return rows.filter(wanted).select(*orders.columns)


def revenue_delta(
    before: DataFrame,
    after: DataFrame,
    dimension_before: DataFrame,
    dimension_after: DataFrame | None = None,
    keys: DataFrame | None = None,
    moved: DataFrame | None = None,
) -> DataFrame:
    """The signed parts that lead from one state of orders and dimension to the next.

    ``keys`` has the ``order_id`` of every order that was inserted, updated or deleted, ``moved`` the customers whose
    versions changed, as of ``moved_since``.  Only these orders are attributed, once as they were and once as they
    are.  Keys that changed nothing cancel out.
    """
    after_dim = dimension_before if dimension_after is None else dimension_after
    old = revenue_parts(_touched(before, keys, moved), dimension_before, -1)
    new = revenue_parts(_touched(after, keys, moved), after_dim, 1)
    return fold_parts(old.unionByName(new))


def revenue_of_parts(parts: DataFrame, generated_at=None, keep_empty: bool = False) -> DataFrame:
    """The rollup's rows from folded parts, equal to those of ``portfolio_revenue``.

    ``keep_empty`` keeps groups that lost their last order, with a count of 0.
    """

    def total(status: str) -> Column:
        amount = F.sum(f"{status}_sum").cast(_EXACT)
        return F.when(F.sum(f"{status}_amounts") > 0, amount)

    paid = F.sum("paid_orders")
    # The type of a plain sum of amounts, so that the mean is rounded from the same digits.
    mean_paid = F.round(total("paid").cast("decimal(28,2)") / paid, 2).cast("double")
    out = parts.groupBy(*GROUP).agg(
        F.sum("orders").alias("order_count"),
        paid.alias("paid_order_count"),
        F.count_if(F.col("orders") > 0).alias("active_customers"),
        total("paid").alias("paid_revenue"),
        total("pending").alias("pending_amount"),
        total("refunded").alias("refunded_amount"),
        F.when(paid > 0, mean_paid).alias("avg_paid_order_value"),
    )
    if not keep_empty:
        out = out.filter(F.col("order_count") > 0)
    if generated_at is not None:
        out = out.withColumn("generated_at", instant(generated_at))
    return out
