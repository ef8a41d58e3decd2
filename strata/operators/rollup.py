"""The gold rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import instant, month_of
from strata.operators.attribution import point_in_time_join

OWNER = ("region", "tier", "portfolio_id", "portfolio_name", "manager_id", "manager_name")


def portfolio_revenue(
    orders: DataFrame, dimension: DataFrame, generated_at=None, method: str = "auto"
) -> DataFrame:
    """Monthly revenue per portfolio as owned at the time of each order.

    Sums are null, counts zero, where no order has the status.  All six owner
    attributes are group keys, so a portfolio that changed its manager within a
    month has a row for each.
    """
    # The key only spreads orders that are otherwise alike; unused, it is pruned.
    facts = orders.filter(
        F.col("customer_id").isNotNull() & F.col("order_date").isNotNull()
    ).select("order_id", "customer_id", "order_date", "amount", "status")
    attributed = point_in_time_join(
        facts, dimension, "customer_id", "order_date", OWNER, method=method
    )
    return monthly_rollup(attributed, generated_at)


def monthly_rollup(attributed: DataFrame, generated_at=None) -> DataFrame:
    def amount_where(status: str):
        return F.when(F.col("status") == status, F.col("amount"))

    def total(status: str):
        return F.sum(amount_where(status)).cast("decimal(38,2)")

    paid = F.col("status") == "paid"
    # The mean is taken on exact decimals and rounded half up before it becomes a double.
    mean_paid = F.round(F.sum(amount_where("paid")) / F.count_if(paid), 2).cast("double")
    out = (
        attributed.withColumn("order_month", month_of("order_date"))
        .groupBy(*OWNER, "order_month")
        .agg(
            F.count("*").alias("order_count"),
            F.count_if(paid).alias("paid_order_count"),
            F.count_distinct("customer_id").alias("active_customers"),
            total("paid").alias("paid_revenue"),
            total("pending").alias("pending_amount"),
            total("refunded").alias("refunded_amount"),
            F.when(F.count_if(paid) > 0, mean_paid).alias("avg_paid_order_value"),
        )
    )
    if generated_at is not None:
        out = out.withColumn("generated_at", instant(generated_at))
    return out
