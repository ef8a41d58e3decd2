"""The benchmark tables in the shape of the lakehouse's raw sources.

The raw rows are text, and dirty in ways that follow from the key, so that the
oracle can state the same rows in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.models import portfolio_versions
from strata.operators.history import scd2_step
from strata.schema import OP
from strata.session import scratch_dir
from strata.sources.tables import HistoryTable, Lakehouse

LOADED = "2026-01-01 00:00:00"
BATCH_1 = "2026-01-02 00:00:00"
BATCH_2 = "2026-01-03 00:00:00"
SNAPSHOT_TIMES = {
    1: "1997-01-01 12:00:00",
    2: "1998-06-01 12:00:00",
    3: "2000-01-01 12:00:00",
}

#: Statements for the guard; an event's number and kind are put in.
STATEMENTS = (
    "select {k} as k",
    "-- {name}\nselect count(*) as n from region where r_name = '{name}; drop'",
    "with t as (select {k} as k) select k from t;",
    "select 'reflect(' as a, {k} as k",
    "drop table region_{k}",
    "select {k}; select 1",
    "insert into region select {k}, '{name}', ''",
    "select reflect('java.lang.System', '{name}')",
    r"select r'\' as a, reflect('java.lang.System', 'nanoTime') as h, '' as b, {k} as k",
    r"select {k} as k where exists(select r'\', java_method('java.lang.System', 'nanoTime'), '')",
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and times as text, which every client compares alike."""
    columns = []
    for f in df.schema:
        kind = f.dataType.typeName()
        to = {"decimal": "double", "date": "string", "timestamp": "string", "timestamp_ntz": "string"}
        columns.append(F.col(f.name).cast(to[kind]).alias(f.name) if kind in to else F.col(f.name))
    return df.select(*columns)


def text(c: Column) -> Column:
    return c.cast("string")


def _dirty(c: Column, k: Column) -> Column:
    return (
        F.when(k % 97 == 0, F.lit(None))
        .when(k % 3 == 0, F.upper(c))
        .when(k % 3 == 1, F.concat(F.lit("  "), c, F.lit(" ")))
        .otherwise(c)
    )


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "O", "pending")
        .when(F.col("o_orderstatus") == "F", "paid")
        .otherwise("refunded")
    )
    return table(spark, sf, "orders").select(
        text(k).alias("order_id"),
        text(F.col("o_custkey")).alias("customer_id"),
        text(k % 200).alias("product_id"),
        text(k % 10 + 1).alias("quantity"),
        text(F.col("o_orderdate").cast("date")).alias("order_date"),
        text(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"),
        _dirty(status, k).alias("status"),
    )


def raw_clients(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        table(spark, sf, "customer")
        .join(nation, "c_nationkey", "left")
        .select(
            text(k).alias("customer_id"),
            F.concat(F.lit(" "), F.col("c_name"), F.lit("  ")).alias("name"),
            F.when(
                k % 50 != 0, F.concat(F.lit(" Client"), text(k), F.lit("@Example.COM "))
            ).alias("email"),
            F.concat(F.lower("n_name"), F.lit(" ")).alias("country"),
            text(F.date_add(F.lit("2020-01-01").cast("date"), (k % 1000).cast("int"))).alias(
                "signup_date"
            ),
            _dirty(F.initcap("c_mktsegment"), k).alias("segment"),
        )
    )


def raw_inventory(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(
        text(k).alias("product_id"),
        text(F.col("p_size") % 10 + 1).alias("warehouse_id"),
        F.concat(F.lit(" "), F.col("p_type")).alias("category"),
        text(F.col("p_size") * 10).alias("quantity_on_hand"),
        text(F.col("p_retailprice").cast("decimal(18,2)")).alias("unit_cost"),
        text(F.date_add(F.lit("2024-01-01").cast("date"), (k % 365).cast("int"))).alias(
            "last_restock_date"
        ),
        F.when(k % 11 == 0, F.lit(None))
        .when(k % 10 == 0, " Discontinued")
        .otherwise("ACTIVE ")
        .alias("status"),
    )


def customers_by_region(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    regions = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    located = table(spark, sf, "customer").join(nations, "c_nationkey", "left")
    return located.join(regions, "n_regionkey", "left").select("c_custkey", "r_name")


def raw_snapshot(
    spark: SparkSession, sf: str, n: int = 0, customers: DataFrame | None = None
) -> DataFrame:
    """Full portfolio snapshot ``n``.

    From 1 on some customers have moved on, in 2 and 3 some portfolios have a
    new manager, and 2 leaves some customers out.
    """
    k = F.col("c_custkey")
    base = k % 50 + 1
    portfolio = F.when((k % 37 == 0) & F.lit(n >= 1), base % 50 + 1).otherwise(base)
    p = F.col("_p")
    manager = (p - 1) % 10 + 1 + F.when((p % 11 == 0) & F.lit(n >= 2), 100).otherwise(0)
    # The tiers in portfolio order.
    tiers = F.array(*[F.lit(t) for t in ("platinum", "gold", "silver", "bronze")])
    tier = F.element_at(tiers, ((p - 1) % 4 + 1).cast("int"))
    rows = customers_by_region(spark, sf) if customers is None else customers
    if n == 2:
        rows = rows.filter(k % 101 != 0)
    return (
        rows.withColumn("_p", portfolio)
        .select(
            text(k).alias("customer_id"),
            text(p).alias("portfolio_id"),
            F.concat(F.lit(" Portfolio "), text(p)).alias("portfolio_name"),
            text(manager).alias("manager_id"),
            F.concat(F.lit("Manager "), text(manager), F.lit(" ")).alias("manager_name"),
            F.when(k % 2 == 0, F.lower("r_name")).otherwise(F.col("r_name")).alias("region"),
            F.when(k % 3 == 0, F.concat(F.upper(tier), F.lit(" "))).otherwise(tier).alias("tier"),
        )
    )


def _change(rows: DataFrame, op: str, seq: int, **changed: Column) -> DataFrame:
    return rows.withColumns({**changed, OP: F.lit(op), "_cdc_seq": F.lit(seq)})


def _times(n: int) -> Column:
    return text(F.col("amount").cast("decimal(18,2)") * n)


def _key_classes(spark: SparkSession, sf: str, first: int, last: int) -> DataFrame:
    """Orders whose key falls into some classes of 200, with the class as ``_m``."""
    classes = F.col("order_id").cast("bigint") % 200
    return raw_orders(spark, sf).withColumn("_m", classes).filter(F.col("_m").between(first, last))


def _by_class(default: Column | str, **cases: Column | str) -> Column:
    """A value per key class: ``m3=...`` is the value of class 3."""
    chosen = F.lit(default) if isinstance(default, str) else default
    for name, value in cases.items():
        value = F.lit(value) if isinstance(value, str) else value
        chosen = F.when(F.col("_m") == int(name[1:]), value).otherwise(chosen)
    return chosen


def raw_batch_1(spark: SparkSession, sf: str) -> DataFrame:
    """Changes in key classes of 200: delete (0), double (1 to 4), new keys (5)."""
    new_key = text(F.col("order_id").cast("bigint") + 1_000_000_000)
    return (
        _key_classes(spark, sf, 0, 5)
        .withColumns(
            {
                "order_id": _by_class(F.col("order_id"), m5=new_key),
                "amount": _by_class(_times(2), m0=F.col("amount"), m5=F.col("amount")),
                OP: _by_class("u ", m0=" d", m5="I"),
                "_cdc_seq": F.lit(1),
            }
        )
        .drop("_m")
    )


def raw_batch_2(spark: SparkSession, sf: str) -> DataFrame:
    """Touches keys that batch 1 changed (3, 4) or added (5), and some others (6)."""
    new_key = text(F.col("order_id").cast("bigint") + 1_000_000_000)
    return (
        _key_classes(spark, sf, 3, 6)
        .withColumns(
            {
                "order_id": _by_class(F.col("order_id"), m5=new_key),
                "amount": _by_class(F.col("amount"), m4=_times(3), m5=_times(4), m6=_times(5)),
                OP: _by_class("U", m3="D", m6="I"),
                "_cdc_seq": F.lit(1),
            }
        )
        .drop("_m")
    )


def raw_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """A batch with every ambiguity: delete beside update, two updates, a delete
    of an unknown key, a null and an unknown operation."""
    orders = raw_orders(spark, sf).withColumn("_m", F.col("order_id").cast("bigint") % 100)
    unknown_key = text(F.col("order_id").cast("bigint") + 2_000_000_000)
    null = F.lit(None).cast("string")
    parts = [
        _change(orders.filter("_m = 0"), "D", 1),
        _change(orders.filter("_m = 0"), "U", 2, amount=_times(2)),
        _change(orders.filter("_m = 1"), "U", 1, amount=_times(2)),
        _change(orders.filter("_m = 1"), "U", 2, amount=_times(3), status=null),
        _change(orders.filter("_m = 2"), "D", 1, order_id=unknown_key),
        _change(orders.filter("_m = 3"), "U", 1, amount=_times(9)).withColumn(OP, null),
        _change(orders.filter("_m = 4"), "x", 1, amount=_times(7)),
        _change(orders.filter("_m = 5"), "U", 1, order_id=unknown_key),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop("_m")


def dimension(spark: SparkSession, sf: str, rounds: int) -> HistoryTable:
    """The dimension after the first ``rounds`` snapshots, each round stored."""
    lake = Lakehouse(spark, scratch_dir(spark, "dimension"))
    dim = lake.history("silver.dim_client_portfolio")
    customers = customers_by_region(spark, sf)
    dim.overwrite(portfolio_versions(raw_snapshot(spark, sf, 0, customers)))
    for n in range(1, rounds + 1):
        at = SNAPSHOT_TIMES[n]
        versions = portfolio_versions(raw_snapshot(spark, sf, n, customers), at)
        dim.advance(lambda present, v=versions, t=at: scd2_step(present, v, "customer_id", t))
    return dim
