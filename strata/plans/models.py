"""The tables of the lakehouse as functions of their inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators.changes import merge_changes
from strata.operators.conform import conform
from strata.operators.dedup import first_per_key
from strata.operators.history import as_versions, scd2_apply, scd2_initial
from strata.operators.quality import (
    Accepted,
    CurrentFlag,
    NoOverlap,
    NotNull,
    Related,
    Rule,
    Unique,
)
from strata.operators.rollup import portfolio_revenue
from strata.schema import (
    CLIENT_SEGMENTS,
    CLIENTS,
    INVENTORY,
    INVENTORY_STATUSES,
    ORDER_STATUSES,
    ORDERS,
    PORTFOLIO_TIERS,
    PORTFOLIO_TRACKED,
    PORTFOLIOS,
    SOURCE_FILE,
    Entity,
)

PRESERVED = ("ingestion_time",)
VERSION_KEY = "portfolio_version_key"

STG_ORDERS = "silver.stg_orders"
STG_CLIENTS = "silver.stg_clients"
STG_INVENTORY = "silver.stg_inventory"
DIM_PORTFOLIO = "silver.dim_client_portfolio"
FCT_REVENUE = "gold.fct_portfolio_revenue"

STAGED: dict[str, Entity] = {
    STG_CLIENTS: CLIENTS,
    STG_INVENTORY: INVENTORY,
    STG_ORDERS: ORDERS,
}


def staged_baseline(raw: DataFrame, entity: Entity, batch_ts) -> DataFrame:
    return conform(raw, entity, batch_ts)


def staged_changes(
    present: DataFrame,
    raw_changes: DataFrame,
    entity: Entity,
    batch_ts,
    order_by: tuple[str, ...] = (),
    strategy: str = "auto",
) -> DataFrame:
    """The staged table after a raw change batch; the first load time of a row is kept."""
    keep = [c for c in (SOURCE_FILE, *order_by) if c in raw_changes.columns]
    changes = conform(raw_changes, entity, batch_ts, changes=True, keep=list(dict.fromkeys(keep)))
    return merge_changes(
        present,
        changes,
        entity.key,
        preserve=PRESERVED,
        order_by=list(dict.fromkeys(keep)),
        strategy=strategy,
    )


def portfolio_snapshot(raw: DataFrame) -> DataFrame:
    """The typed snapshot, one row per customer: the lowest portfolio id wins."""
    typed = conform(raw, PORTFOLIOS)
    return first_per_key(typed, PORTFOLIOS.key, ["portfolio_id"])


def portfolio_versions(raw: DataFrame, valid_from=None) -> DataFrame:
    """Open versions of a raw snapshot; without a time, those of the first load."""
    snapshot = portfolio_snapshot(raw)
    if valid_from is None:
        return scd2_initial(snapshot, PORTFOLIOS.key, PORTFOLIO_TRACKED, surrogate=VERSION_KEY)
    return as_versions(
        snapshot, PORTFOLIOS.key, PORTFOLIO_TRACKED, valid_from, surrogate=VERSION_KEY
    )


def dim_client_portfolio(
    present: DataFrame | None, raw_snapshot: DataFrame, batch_ts=None
) -> DataFrame:
    """The dimension after a snapshot; its first load when there is none yet."""
    if present is None:
        return portfolio_versions(raw_snapshot)
    versions = portfolio_versions(raw_snapshot, batch_ts)
    return scd2_apply(present, versions, PORTFOLIOS.key, batch_ts)


def fct_portfolio_revenue(
    orders: DataFrame, dimension: DataFrame, generated_at=None, method: str = "auto"
) -> DataFrame:
    return portfolio_revenue(orders, dimension, generated_at, method)


# The rules of each table, by column.
RULES: tuple[Rule, ...] = (
    Unique(STG_ORDERS, "order_id"),
    NotNull(STG_ORDERS, "order_id"),
    Related(STG_ORDERS, "customer_id", STG_CLIENTS, "customer_id"),
    Related(STG_ORDERS, "product_id", STG_INVENTORY, "product_id"),
    NotNull(STG_ORDERS, "quantity"),
    NotNull(STG_ORDERS, "amount"),
    Accepted(STG_ORDERS, "status", ORDER_STATUSES),
    Unique(STG_CLIENTS, "customer_id"),
    NotNull(STG_CLIENTS, "customer_id"),
    NotNull(STG_CLIENTS, "country"),
    Accepted(STG_CLIENTS, "segment", CLIENT_SEGMENTS),
    Unique(STG_INVENTORY, "product_id"),
    NotNull(STG_INVENTORY, "product_id"),
    NotNull(STG_INVENTORY, "warehouse_id"),
    Accepted(STG_INVENTORY, "status", INVENTORY_STATUSES),
    Unique(DIM_PORTFOLIO, VERSION_KEY),
    NotNull(DIM_PORTFOLIO, VERSION_KEY),
    NotNull(DIM_PORTFOLIO, "customer_id"),
    Unique(DIM_PORTFOLIO, "customer_id", where="is_current"),
    NotNull(DIM_PORTFOLIO, "portfolio_id"),
    NotNull(DIM_PORTFOLIO, "manager_id"),
    NotNull(DIM_PORTFOLIO, "valid_from"),
    NotNull(DIM_PORTFOLIO, "is_current"),
    Accepted(DIM_PORTFOLIO, "tier", PORTFOLIO_TIERS),
    NoOverlap(DIM_PORTFOLIO, "customer_id"),
    CurrentFlag(DIM_PORTFOLIO),
    NotNull(FCT_REVENUE, "order_month"),
    NotNull(FCT_REVENUE, "portfolio_id"),
    Related(FCT_REVENUE, "portfolio_id", DIM_PORTFOLIO, "portfolio_id"),
    NotNull(FCT_REVENUE, "manager_id"),
    NotNull(FCT_REVENUE, "order_count"),
    NotNull(FCT_REVENUE, "active_customers"),
    Accepted(FCT_REVENUE, "tier", PORTFOLIO_TIERS),
)
