"""Column specs of the entities: one source for the raw read schema, the
typed silver columns, and both the baseline and the change-batch branch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

OP = "_cdc_op"
SOURCE_FILE = "_source_file"
ARRIVAL = "_arrival"
AUDIT = ("ingestion_time", "last_updated_time")


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    clean: str | None = None  # trim, lower or upper; text columns only


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    fields: tuple[Field, ...]

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def raw_schema(self, changes: bool = False) -> T.StructType:
        """All-text read schema; no inference pass, casts happen in ``conform``."""
        names = self.columns + ([OP] if changes else [])
        return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


ORDERS = Entity(
    "orders",
    "order_id",
    (
        Field("order_id", "bigint"),
        Field("customer_id", "bigint"),
        Field("product_id", "bigint"),
        Field("quantity", "int"),
        Field("order_date", "date"),
        Field("amount", "decimal(18,2)"),
        Field("status", "string", "lower"),
    ),
)

CLIENTS = Entity(
    "clients",
    "customer_id",
    (
        Field("customer_id", "bigint"),
        Field("name", "string", "trim"),
        Field("email", "string", "lower"),
        Field("country", "string", "upper"),
        Field("signup_date", "date"),
        Field("segment", "string", "lower"),
    ),
)

INVENTORY = Entity(
    "inventory",
    "product_id",
    (
        Field("product_id", "bigint"),
        Field("warehouse_id", "int"),
        Field("category", "string", "trim"),
        Field("quantity_on_hand", "int"),
        Field("unit_cost", "decimal(18,2)"),
        Field("last_restock_date", "date"),
        Field("status", "string", "lower"),
    ),
)

PORTFOLIOS = Entity(
    "portfolios",
    "customer_id",
    (
        Field("customer_id", "bigint"),
        Field("portfolio_id", "bigint"),
        Field("portfolio_name", "string", "trim"),
        Field("manager_id", "bigint"),
        Field("manager_name", "string", "trim"),
        Field("region", "string", "upper"),
        Field("tier", "string", "lower"),
    ),
)

# The portfolio columns whose change opens a new version.
PORTFOLIO_TRACKED = ("portfolio_id", "manager_id", "region", "tier")

# Accepted codes per column.
ORDER_STATUSES = ("paid", "pending", "cancelled", "refunded")
CLIENT_SEGMENTS = ("retail", "wholesale", "vip")
INVENTORY_STATUSES = ("active", "discontinued")
PORTFOLIO_TIERS = ("platinum", "gold", "silver", "bronze")
