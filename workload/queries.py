"""One query per operator, over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import strata.operators.quality as q
from strata.functions.columns import clean, differs, month_of
from strata.operators.attribution import attribution_shift, current_join, point_in_time_join
from strata.operators.changes import (
    check_batch,
    diff_snapshots,
    exclusive_split,
    merge_changes,
    op_counts,
)
from strata.operators.conform import conform, split_rejects
from strata.operators.dedup import first_per_key
from strata.operators.digests import RangedSnapshot, diff_by_digests, diff_stored
from strata.operators.distinct import count_members, distinct_bitmaps, merge_bitmaps
from strata.operators.hierarchy import dense_index, extend_index, parent_catalog, propagate_parents
from strata.operators.history import changed_keys, scd2_apply, scd2_as_of, scd2_backlog, scd2_current
from strata.operators.keyed import patch_rows, resolve_unique
from strata.operators.rollup import portfolio_revenue
from strata.operators.rollup_parts import moved_since, revenue_delta
from strata.plans import adhoc
from strata.plans.models import (
    portfolio_snapshot,
    portfolio_versions,
    staged_changes,
)
from strata.plans.pipeline import build
from strata.plans.revenue import RevenueLedger
from strata.schema import (
    ARRIVAL,
    CLIENT_SEGMENTS,
    CLIENTS,
    INVENTORY,
    OP,
    ORDER_STATUSES,
    ORDERS,
    PORTFOLIO_TRACKED,
    PORTFOLIOS,
    SOURCE_FILE,
)
from strata.session import scratch_dir
from strata.sources.files import (
    land,
    read_change_files,
    read_csv_apart,
    read_full_load,
    replace_snapshot,
    write_csv,
    write_parquet,
)
from strata.sources.tables import Lakehouse
from strata.streaming.files import apply_change_files, apply_snapshot_files, merge_stream
from workload import bindings as b
from workload.bindings import portable, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return conform(b.raw_orders(spark, sf), ORDERS)


def _staged_orders(spark: SparkSession, sf: str) -> DataFrame:
    return conform(b.raw_orders(spark, sf), ORDERS, b.LOADED)


# -- gold ----------------------------------------------------------------
@query
def gold_portfolio_revenue(spark, sf):
    versions = portfolio_versions(b.raw_snapshot(spark, sf))
    return portable(portfolio_revenue(_orders(spark, sf), versions))


@query
def gold_after_changes(spark, sf):
    orders = staged_changes(
        _staged_orders(spark, sf), b.raw_batch_1(spark, sf), ORDERS, b.BATCH_1, ("_cdc_seq",)
    )
    return portable(portfolio_revenue(orders, b.dimension(spark, sf, 3).read()))


@query
def gold_incremental(spark, sf):
    """Two change batches and a dimension round, each brought into gold by what it changed."""
    folder = scratch_dir(spark, "ledger")

    def stored(rows, name):
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    ledger = RevenueLedger(spark, folder)
    orders = stored(_staged_orders(spark, sf), "orders-0")
    first = stored(portfolio_versions(b.raw_snapshot(spark, sf)), "dimension-0")
    ledger.load(orders, first)
    for n, (raw, at) in enumerate(((b.raw_batch_1, b.BATCH_1), (b.raw_batch_2, b.BATCH_2)), 1):
        changes = raw(spark, sf)
        after = stored(staged_changes(orders, changes, ORDERS, at, ("_cdc_seq",)), f"orders-{n}")
        keys = changes.select(F.col("order_id").cast("bigint").alias("order_id"))
        ledger.apply(n, revenue_delta(orders, after, first, keys=keys))
        orders = after
    at = b.SNAPSHOT_TIMES[1]
    second = stored(scd2_apply(first, portfolio_versions(b.raw_snapshot(spark, sf, 1), at), "customer_id"), "dimension-1")
    ledger.apply(3, revenue_delta(orders, orders, first, second, moved=moved_since(second, at)))
    return portable(ledger.read())


@query
def active_customers(spark, sf):
    """Distinct customers of each tier by month, and by year from the months' bitmaps alone."""
    folder = scratch_dir(spark, "bitmaps")
    facts = _orders(spark, sf).select("order_id", "customer_id", "order_date")
    owned = point_in_time_join(facts, b.dimension(spark, sf, 3).read(), "customer_id", "order_date", ("tier",))
    numbered = owned.join(dense_index(owned, "customer_id"), "customer_id")
    months = distinct_bitmaps(numbered, ["tier", month_of("order_date").alias("period")], "idx")
    months.write.parquet(folder)
    months = spark.read.parquet(folder)
    years = merge_bitmaps(months, ["tier", F.trunc("period", "year").alias("period")])
    both = months.withColumn("span", F.lit("month")).unionByName(years.withColumn("span", F.lit("year")))
    return portable(count_members(both, ["span", "tier", "period"], "active_customers"))


# -- staged tables -------------------------------------------------------
@query
def stg_orders_baseline(spark, sf):
    return portable(_staged_orders(spark, sf))


@query
def stg_clients_baseline(spark, sf):
    return portable(conform(b.raw_clients(spark, sf), CLIENTS, b.LOADED))


@query
def stg_inventory_baseline(spark, sf):
    return portable(conform(b.raw_inventory(spark, sf), INVENTORY, b.LOADED))


@query
def rejected_rows(spark, sf):
    """Amounts that are no number and keys that are no integer, kept apart."""
    k = F.col("order_id").cast("bigint")
    raw = b.raw_orders(spark, sf).withColumns(
        {
            "amount": F.when(k % 41 == 0, "n/a").otherwise(F.col("amount")),
            "quantity": F.when(k % 59 == 0, "many").otherwise(F.col("quantity")),
        }
    )
    return split_rejects(raw, ORDERS)[1]


# -- change batches ------------------------------------------------------
@query
def cdc_merge_orders(spark, sf):
    return portable(
        staged_changes(
            _staged_orders(spark, sf), b.raw_batch_1(spark, sf), ORDERS, b.BATCH_1, ("_cdc_seq",)
        )
    )


@query
def cdc_merge_orders_outer(spark, sf):
    return portable(
        staged_changes(
            _staged_orders(spark, sf),
            b.raw_batch_1(spark, sf),
            ORDERS,
            b.BATCH_1,
            ("_cdc_seq",),
            strategy="outer",
        )
    )


@query
def cdc_merge_orders_lookup(spark, sf):
    return portable(
        staged_changes(
            _staged_orders(spark, sf),
            b.raw_batch_1(spark, sf),
            ORDERS,
            b.BATCH_1,
            ("_cdc_seq",),
            strategy="lookup",
        )
    )


@query
def cdc_merge_two_batches(spark, sf):
    """Two batches in a row, each stored as a table version before the next."""
    orders = Lakehouse(spark, scratch_dir(spark, "orders")).table("silver.stg_orders")
    orders.overwrite(_staged_orders(spark, sf))
    rounds = ((b.raw_batch_1, b.BATCH_1), (b.raw_batch_2, b.BATCH_2))
    for raw, at in rounds:
        changes = raw(spark, sf)
        orders.update(lambda t, c=changes, a=at: staged_changes(t, c, ORDERS, a, ("_cdc_seq",)))
    return portable(orders.read())


@query
def cdc_sliced_table(spark, sf):
    """Two batches in a row on a table in slices by its key: each writes the slices it touches."""
    orders = Lakehouse(spark, scratch_dir(spark, "sliced")).sliced("silver.stg_orders", ORDERS.key, 16)
    orders.overwrite(_staged_orders(spark, sf))
    for raw, at in ((b.raw_batch_1, b.BATCH_1), (b.raw_batch_2, b.BATCH_2)):
        changes = raw(spark, sf)
        orders.merge(
            changes.select(ORDERS.key),
            lambda t, c=changes, a=at: staged_changes(t, c, ORDERS, a, ("_cdc_seq",)),
        )
    return portable(orders.read())


@query
def cdc_bucketed_table(spark, sf):
    """The first batch on a table bucketed by its key: only the batch is shuffled."""
    lake = Lakehouse(spark, scratch_dir(spark, "bucketed"))
    orders = lake.table("silver.stg_orders", bucket_by=("order_id", 8))
    orders.overwrite(_staged_orders(spark, sf))
    changes = b.raw_batch_1(spark, sf)
    return portable(
        staged_changes(
            orders.read(), changes, ORDERS, b.BATCH_1, ("_cdc_seq",), strategy="outer"
        )
    )


@query
def cdc_conflicting_ops(spark, sf):
    return portable(
        staged_changes(
            _staged_orders(spark, sf),
            b.raw_conflicts(spark, sf),
            ORDERS,
            b.BATCH_1,
            ("_cdc_seq",),
        )
    )


@query
def cdc_op_counts(spark, sf):
    changes = conform(b.raw_conflicts(spark, sf), ORDERS, changes=True)
    return op_counts(changes.unionByName(conform(b.raw_batch_1(spark, sf), ORDERS, changes=True)))


@query
def cdc_batch_check(spark, sf):
    return check_batch(conform(b.raw_conflicts(spark, sf), ORDERS, changes=True), "order_id")


@query
def snapshot_diff(spark, sf):
    before = portfolio_snapshot(b.raw_snapshot(spark, sf, 1))
    after = portfolio_snapshot(b.raw_snapshot(spark, sf, 2))
    return diff_snapshots(before, after, "customer_id", PORTFOLIO_TRACKED)


@query
def snapshot_diff_digests(spark, sf):
    """The same difference from digests of key ranges: rows of ranges with equal digests are not compared."""
    before = portfolio_snapshot(b.raw_snapshot(spark, sf, 1))
    after = portfolio_snapshot(b.raw_snapshot(spark, sf, 2))
    return diff_by_digests(before, after, "customer_id", PORTFOLIO_TRACKED)


@query
def snapshot_diff_stored(spark, sf):
    """The same from two snapshots stored by range, of which only the ranges that differ are read."""
    folder = scratch_dir(spark, "ranged")
    stored = [RangedSnapshot(spark, f"{folder}/{n}", "customer_id", PORTFOLIO_TRACKED) for n in (1, 2)]
    for n, snapshot in enumerate(stored, 1):
        snapshot.write(portfolio_snapshot(b.raw_snapshot(spark, sf, n)))
    return diff_stored(*stored)


@query
def diff_round_trip(spark, sf):
    """Applying the difference of two snapshots to the first gives the second."""
    before = portfolio_snapshot(b.raw_snapshot(spark, sf, 2))
    after = portfolio_snapshot(b.raw_snapshot(spark, sf, 3))
    return merge_changes(before, diff_snapshots(before, after, "customer_id"), "customer_id")


@query
def split_groups(spark, sf):
    """Deletes, updates and the rest by key ranges that cannot overlap."""
    orders = _orders(spark, sf).select("order_id", "customer_id")
    drawn = F.col("order_id") * 7919 % 1000
    labelled = exclusive_split(
        orders, "order_id", {"D": 5, "U": 20}, drawn=drawn, buckets=1000, label="op"
    )
    return labelled.withColumn("op", F.coalesce("op", F.lit("keep")))


# -- dimension -----------------------------------------------------------
@query
def dim_initial(spark, sf):
    return portable(portfolio_versions(b.raw_snapshot(spark, sf)))


@query
def dim_after_snap1(spark, sf):
    """One round without storing anything in between."""
    present = portfolio_versions(b.raw_snapshot(spark, sf))
    at = b.SNAPSHOT_TIMES[1]
    versions = portfolio_versions(b.raw_snapshot(spark, sf, 1), at)
    return portable(scd2_apply(present, versions, "customer_id"))


@query
def dim_after_snap3(spark, sf):
    return portable(b.dimension(spark, sf, 3).read())


@query
def dim_backlog(spark, sf):
    """Three waiting snapshots applied to the first load in one pass."""
    customers = b.customers_by_region(spark, sf)
    first = portfolio_versions(b.raw_snapshot(spark, sf, 0, customers))
    waiting = [
        (portfolio_versions(b.raw_snapshot(spark, sf, n, customers), at), at) for n, at in b.SNAPSHOT_TIMES.items()
    ]
    return portable(scd2_backlog(first, waiting, "customer_id"))


@query
def dim_current(spark, sf):
    return portable(scd2_current(b.dimension(spark, sf, 3).read()))


@query
def dim_as_of_date(spark, sf):
    return portable(scd2_as_of(b.dimension(spark, sf, 3).read(), "1999-01-01 00:00:00"))


@query
def changed_portfolios(spark, sf):
    before = portfolio_snapshot(b.raw_snapshot(spark, sf, 0))
    after = portfolio_snapshot(b.raw_snapshot(spark, sf, 2))
    return changed_keys(before, after, "customer_id", PORTFOLIO_TRACKED)


# -- attribution ---------------------------------------------------------
def _pit(spark, sf, method):
    facts = _orders(spark, sf).select("order_id", "customer_id", "order_date", "amount")
    versions = b.dimension(spark, sf, 3).read()
    return portable(
        point_in_time_join(
            facts,
            versions,
            "customer_id",
            "order_date",
            ("portfolio_version_key", "portfolio_id", "manager_id", "region", "tier"),
            method=method,
        )
    )


@query
def pit_orders(spark, sf):
    return _pit(spark, sf, "range")


@query
def pit_orders_slots(spark, sf):
    return _pit(spark, sf, "slots")


@query
def pit_orders_sweep(spark, sf):
    return _pit(spark, sf, "sweep")


@query
def pit_orders_salted(spark, sf):
    return _pit(spark, sf, "salted")


@query
def pit_orders_left(spark, sf):
    """Every order, also those that no version covers."""
    facts = _orders(spark, sf).select("order_id", "customer_id", "order_date")
    versions = b.dimension(spark, sf, 3).read()
    joined = point_in_time_join(
        facts, versions, "customer_id", "order_date", ("portfolio_version_key",), how="left"
    )
    return portable(joined.withColumn("covered", F.col("portfolio_version_key").isNotNull()))


@query
def attribution_current(spark, sf):
    versions = b.dimension(spark, sf, 3).read()
    facts = _orders(spark, sf).select("order_id", "customer_id", "order_date")
    return portable(
        current_join(facts, versions, "customer_id", ("portfolio_id", "manager_id"))
    )


@query
def attribution_shifts(spark, sf):
    """Orders and amounts that a join on the present owner would move."""
    facts = _orders(spark, sf).select("order_id", "customer_id", "order_date", "amount")
    moved = attribution_shift(
        facts,
        b.dimension(spark, sf, 3).read(),
        "customer_id",
        "order_date",
        ("portfolio_id", "manager_id"),
    )
    owners = ("then_portfolio_id", "then_manager_id", "now_portfolio_id", "now_manager_id")
    return portable(
        moved.groupBy(*owners).agg(
            F.count("*").alias("n_orders"), F.sum("amount").alias("amount_moved")
        )
    )


# -- keys, parents, indexes ----------------------------------------------
@query
def dedup_first(spark, sf):
    """The lowest portfolio of a customer listed twice, once without a portfolio."""
    rows = b.raw_snapshot(spark, sf, 0)
    twice = rows.filter(F.col("customer_id").cast("bigint") % 5 == 0)
    lower = twice.withColumn("portfolio_id", F.lit("0"))
    absent = rows.filter(F.col("customer_id").cast("bigint") % 7 == 0).withColumn(
        "portfolio_id", F.lit(None).cast("string")
    )
    return portfolio_snapshot(rows.unionByName(lower).unionByName(absent))


@query
def dedup_lineitem(spark, sf):
    """The dearest line per order and line number, from a table full of repeats."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"
    )
    return first_per_key(
        lines, ["l_orderkey", "l_linenumber"], [F.col("l_extendedprice").desc_nulls_last()]
    )


@query
def portfolio_catalog(spark, sf):
    """One row per portfolio although its customers disagree about the region."""
    rows = portfolio_snapshot(b.raw_snapshot(spark, sf, 2))
    return parent_catalog(
        rows,
        "portfolio_id",
        ("portfolio_name", "manager_id", "manager_name", "region", "tier"),
        "customer_id",
    )


@query
def dense_ids(spark, sf):
    return dense_index(table(spark, sf, "orders"), "o_custkey")


@query
def stable_ids(spark, sf):
    """Customers numbered in three rounds as they appear; numbers once given stay."""
    folder = scratch_dir(spark, "ids")
    orders = table(spark, sf, "orders")
    known = None
    for n, until in enumerate(("1994-01-01", "1996-01-01", "2100-01-01")):
        seen = orders.filter(F.col("o_orderdate") < F.lit(until).cast("date"))
        rows = dense_index(seen, "o_custkey") if known is None else extend_index(known, seen, "o_custkey")
        rows.write.parquet(f"{folder}/{n}")
        known = spark.read.parquet(f"{folder}/{n}")
    return known


@query
def reassigned_portfolios(spark, sf):
    """Some customers move to the portfolio at a computed index of the dense list."""
    # Ids with gaps, so that the index is not the id.
    rows = portfolio_snapshot(b.raw_snapshot(spark, sf, 0)).select(
        "customer_id", (F.col("portfolio_id") * 3).alias("portfolio_id")
    )
    picks = dense_index(rows, "portfolio_id").withColumnsRenamed({"portfolio_id": "picked"})
    asked = rows.withColumn("idx", (F.col("customer_id") * 31 % 60 + 1).cast("bigint"))
    return asked.join(picks, "idx", "left").select(
        "customer_id",
        F.when(F.col("customer_id") % 33 == 0, F.col("picked"))
        .otherwise(F.col("portfolio_id"))
        .alias("portfolio_id"),
    )


@query
def insert_batch(spark, sf):
    """New orders, one for every hundred there are, of products picked by index."""
    n = table(spark, sf, "orders").count() // 100
    inventory = conform(b.raw_inventory(spark, sf), INVENTORY)
    picks = dense_index(inventory, "product_id")
    costs = inventory.select("product_id", "unit_cost")
    n_products = picks.agg(F.count("*")).scalar()
    quantity = (F.col("id") % 9 + 1).cast("int")
    return portable(
        spark.range(n)
        .withColumn("idx", F.col("id") * 7919 % n_products + 1)
        .join(picks, "idx")
        .join(costs, "product_id")
        .select(
            (F.col("id") + 7_000_000_000).alias("order_id"),
            "product_id",
            quantity.alias("quantity"),
            F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias(
                "order_date"
            ),
            F.round(quantity * F.col("unit_cost") * F.lit("1.15").cast("decimal(3,2)"), 2).alias(
                "amount"
            ),
            F.element_at(
                F.array(F.lit("paid"), F.lit("pending")), (F.col("id") % 2 + 1).cast("int")
            ).alias("status"),
            F.lit("I").alias(OP),
        )
    )


@query
def scalar_functions(spark, sf):
    """The scalar functions of the models, each on a column of the raw orders."""
    k, amount = F.col("order_id").cast("bigint"), F.col("amount").cast("decimal(18,2)")
    day, status = F.col("order_date").cast("date"), F.col("status")
    absent = F.when(k % 5 != 0, status)
    return portable(
        b.raw_orders(spark, sf).select(
            k.alias("order_id"),
            clean("status", "trim").alias("trimmed"),
            clean("status", "lower").alias("lowered"),
            clean("status", "upper").alias("raised"),
            F.concat_ws("|", "order_id", absent, "amount").alias("joined_text"),
            F.concat("order_id", F.lit("/"), absent).alias("glued_text"),
            F.md5(F.concat_ws("|", "order_id", "amount")).alias("digest"),
            month_of(day).alias("month"),
            F.date_add(day, (k % 40).cast("int")).alias("later"),
            F.round(amount * F.lit("0.333").cast("decimal(4,3)"), 2).alias("third"),
            (amount + k - amount * 2).alias("mixed"),
            F.pmod(-k, F.lit(7)).alias("cycle"),
            F.round(amount).cast("bigint").alias("whole"),
            F.coalesce(absent, F.lit("none")).alias("given"),
            F.when(amount > 100_000, "large").when(amount > 1_000, "middle").otherwise("small").alias(
                "size"
            ),
            ((k % 3).isin(0, 1) & ~status.isNull() | (amount <= 500)).alias("picked"),
            differs(status, absent).alias("lost"),
            F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (k % 3 + 1).cast("int")).alias(
                "letter"
            ),
        )
    )


@query
def table_peek(spark, sf):
    """Ten rows of a registered table, by an ad-hoc query."""
    orders = Lakehouse(spark, scratch_dir(spark, "peek")).table("silver.stg_orders")
    orders.overwrite(_orders(spark, sf))
    session = adhoc.read_only_session(spark, [orders])
    sql = "select order_id, customer_id, status from stg_orders order by order_id limit 10"
    return adhoc.query(session, sql)


@query
def parent_change(spark, sf):
    """Some portfolios get a new manager and region; all their customers follow."""
    rows = portfolio_snapshot(b.raw_snapshot(spark, sf, 0))
    attributes = ("portfolio_name", "manager_id", "manager_name", "region", "tier")
    parents = parent_catalog(rows, "portfolio_id", attributes, "customer_id")
    moves = F.col("portfolio_id") % 7 == 0
    manager = F.col("manager_id") + 300
    region = F.concat(F.lit("AREA "), (F.col("portfolio_id") % 3).cast("string"))
    changed = parents.withColumns(
        {
            "manager_id": F.when(moves, manager).otherwise(F.col("manager_id")),
            "manager_name": F.when(
                moves, F.concat(F.lit("Successor "), manager.cast("string"))
            ).otherwise(F.col("manager_name")),
            "region": F.when(moves, region).otherwise(F.col("region")),
        }
    )
    return propagate_parents(rows, changed, "portfolio_id", attributes)


@query
def patch_rows_by_key(spark, sf):
    """Several partial updates per client; the last value given counts."""
    clients = conform(b.raw_clients(spark, sf), CLIENTS).select(
        "customer_id", "email", "country", "segment"
    )
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("customer_id"),
        "event_id",
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("e"), text_of("event_id"))).alias("email"),
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("C"), text_of("event_id"))).alias("country"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("segment"),
    )
    return patch_rows(clients, events, "customer_id", ["event_id"], overwrite=["segment"])


def text_of(name: str):
    return F.col(name).cast("string")


@query
def insert_unique_names(spark, sf):
    """Suppliers offered as clients: refused where the name is taken or repeats."""
    taken = table(spark, sf, "customer").select(
        (F.col("c_custkey") % 40).alias("name"), F.col("c_custkey").alias("id")
    )
    offered = table(spark, sf, "orders").select(
        (F.col("o_orderkey") % 600).alias("name"), F.col("o_orderkey").alias("id")
    )
    return resolve_unique(taken, offered, "name", ["id"])


# -- quality -------------------------------------------------------------
@query
def q_unique(spark, sf):
    return q.unique_failures(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def q_unique_where(spark, sf):
    """Customers with two open versions, where some were opened twice."""
    dim = b.dimension(spark, sf, 2).read()
    again = dim.filter((F.col("customer_id") % 13 == 0) & F.col("is_current"))
    return q.unique_failures(dim.unionByName(again), "customer_id", where="is_current")


@query
def q_not_null(spark, sf):
    return portable(q.not_null_failures(_orders(spark, sf), "status"))


@query
def q_accepted(spark, sf):
    """Market segments are none of the accepted client segments."""
    clients = conform(b.raw_clients(spark, sf), CLIENTS)
    return q.accepted_failures(clients, "segment", ("building", "machinery", *CLIENT_SEGMENTS))


@query
def q_relationships(spark, sf):
    """Orders of products that the inventory does not hold."""
    orders = _orders(spark, sf).withColumn(
        "product_id",
        F.when(F.col("order_id") % 50 == 0, -(F.col("order_id") % 20) - 1)
        .when(F.col("order_id") % 51 == 0, F.lit(None))
        .otherwise(F.col("product_id")),
    )
    inventory = conform(b.raw_inventory(spark, sf), INVENTORY)
    return q.orphan_failures(orders, "product_id", inventory, "product_id")


def _faulty(spark, sf):
    """A dimension with ends moved past the next start, ends removed, and flags flipped."""
    k = F.col("customer_id")
    closed = ~F.col("is_current")
    return b.dimension(spark, sf, 3).read().withColumns(
        {
            "valid_to": F.when(closed & (k % 3 == 0), F.col("valid_to") + F.expr("interval 1 day"))
            .when(closed & (k % 3 == 1), F.lit(None).cast("timestamp_ntz"))
            .otherwise(F.col("valid_to")),
        }
    )


@query
def q_overlap(spark, sf):
    return portable(q.overlap_failures(_faulty(spark, sf), "customer_id"))


@query
def q_current_flag(spark, sf):
    return portable(
        q.current_flag_failures(_faulty(spark, sf)).select(
            "portfolio_version_key", "customer_id", "valid_from", "is_current"
        )
    )


@query
def q_population(spark, sf):
    before = portfolio_snapshot(b.raw_snapshot(spark, sf, 0))
    after = portfolio_snapshot(b.raw_snapshot(spark, sf, 2))
    return q.population(before, after, "customer_id")


@query
def q_reconcile(spark, sf):
    before = _staged_orders(spark, sf)
    changes = conform(
        b.raw_batch_1(spark, sf), ORDERS, b.BATCH_1, changes=True, keep=["_cdc_seq"]
    )
    after = merge_changes(
        before, changes, "order_id", preserve=["ingestion_time"], order_by=["_cdc_seq"]
    )
    return q.reconcile_counts(before, after, changes)


@query
def q_version_growth(spark, sf):
    dim = b.dimension(spark, sf, 1)
    return q.version_growth(
        portfolio_snapshot(b.raw_snapshot(spark, sf, 0)),
        portfolio_snapshot(b.raw_snapshot(spark, sf, 1)),
        dim.read(0),
        dim.read(1),
        "customer_id",
        PORTFOLIO_TRACKED,
    )


@query
def q_suite(spark, sf):
    """A whole suite in one report, on tables that break some of its rules."""
    orders = _orders(spark, sf).withColumn(
        "product_id",
        F.when(F.col("order_id") % 50 == 0, F.lit(-1)).otherwise(F.col("product_id")),
    )
    tables = {
        "orders": orders,
        "clients": conform(b.raw_clients(spark, sf), CLIENTS),
        "inventory": conform(b.raw_inventory(spark, sf), INVENTORY),
        "dimension": _faulty(spark, sf),
    }
    rules = [
        q.Unique("orders", "order_id"),
        q.Unique("orders", "customer_id"),
        q.NotNull("orders", "status"),
        q.NotNull("orders", "amount"),
        q.Accepted("orders", "status", ORDER_STATUSES),
        q.Accepted("clients", "segment", CLIENT_SEGMENTS),
        q.Related("orders", "product_id", "inventory", "product_id"),
        q.Related("orders", "customer_id", "clients", "customer_id"),
        q.Unique("dimension", "customer_id", where="is_current"),
        q.NoOverlap("dimension", "customer_id"),
        q.CurrentFlag("dimension"),
    ]
    return q.run_suite(tables, rules)


# -- ad-hoc SQL and the job log ------------------------------------------
def _job_events(spark, sf):
    """The events as status records of jobs of three steps."""
    step = (F.col("event_id") % 3).cast("int")
    job = F.floor(F.col("event_id") / 3)
    at = F.col("ts").cast("string")
    failed = job % 5 == 0
    return table(spark, sf, "events").select(
        job.alias("job_id"),
        step.alias("step"),
        F.when(step == 0, F.concat(F.lit("select "), text_of("user_id"))).alias("sql"),
        F.when(step == 0, "queued")
        .when(step == 1, "running")
        .when(failed, "failed")
        .otherwise("succeeded")
        .alias("status"),
        F.when(step == 0, at).alias("submitted_at"),
        F.when(step == 1, at).alias("started_at"),
        F.when(step == 2, at).alias("finished_at"),
        F.when((step == 2) & ~failed, F.col("user_id")).alias("row_count"),
        F.when((step == 2) & failed, F.col("event_type")).alias("error"),
    )


@query
def run_log(spark, sf):
    return adhoc.fold_runs(_job_events(spark, sf), order_by=["step"]).fillna(
        {"row_count": -1}
    )


@query
def job_records(spark, sf):
    """Each job's state as a JSON record, and what a client reads back from it."""
    runs = adhoc.fold_runs(_job_events(spark, sf), order_by=["step"])
    record = F.to_json(F.struct("job_id", "sql", "status", "row_count", "error"))
    read = F.from_json("record", "job_id long, status string, row_count long")
    return (
        runs.select("job_id", record.alias("record"))
        .withColumn("read", read)
        .select("job_id", "record", "read.status", F.coalesce("read.row_count", F.lit(-1)).alias("row_count"))
    )


@query
def guard_verdicts(spark, sf):
    """A statement made from each event, and whether the guard lets it run."""
    texts = F.array(*[F.lit(t) for t in b.STATEMENTS])
    pattern = F.element_at(texts, (F.col("event_id") % len(b.STATEMENTS) + 1).cast("int"))
    statement = F.replace(F.replace(pattern, F.lit("{k}"), text_of("event_id")), F.lit("{name}"), F.col("event_type"))
    jobs = table(spark, sf, "events").select("event_id", statement.alias("statement"))
    return jobs.withColumn("accepted", adhoc.verdicts("statement"))


@query
def order_ages(spark, sf):
    """Days from each order to the date of the batch."""
    batch_date = F.lit(b.BATCH_2).cast("timestamp").cast("date")
    orders = _orders(spark, sf).select("order_id", F.date_diff(batch_date, "order_date").alias("age_days"))
    return orders.withColumn("batch_date", batch_date.cast("string"))


@query
def recent_jobs(spark, sf):
    runs = adhoc.fold_runs(_job_events(spark, sf), order_by=["step"])
    return adhoc.recent_runs(runs).select("job_id", "sql", "status", "submitted_at")


@query
def jobs_by_name(spark, sf):
    saved = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), "s_suppkey")
    return adhoc.by_name(saved)


@query
def adhoc_region_counts(spark, sf):
    """A user's SQL over the gold table, run as a job: stored, counted and read back."""
    lake = Lakehouse(spark, scratch_dir(spark, "adhoc"))
    gold = lake.table("gold.fct_portfolio_revenue")
    versions = portfolio_versions(b.raw_snapshot(spark, sf))
    gold.overwrite(portfolio_revenue(_orders(spark, sf), versions))
    log = adhoc.JobLog(spark, f"{lake.root}/jobs")
    sql = (
        "-- months and orders per region\n"
        "select region, count(*) as n, sum(order_count) as orders\n"
        "from gold.fct_portfolio_revenue group by 1;"
    )
    job = adhoc.submit(log, sql)
    state = adhoc.run_job(spark, log, job, f"{lake.root}/results", [gold])
    if state != "succeeded":
        raise RuntimeError(log.runs().select("error").first()["error"])
    return adhoc.read_result(spark, f"{lake.root}/results", job)


@query
def adhoc_preview(spark, sf):
    """The first rows of a result as a client would show them."""
    orders = _orders(spark, sf).orderBy("order_id")
    return adhoc.preview(orders.select("order_id", "order_date", "amount", "quantity"))


# -- files and streams ---------------------------------------------------
@query
def csv_full_load(spark, sf):
    """Raw orders through headered CSV files and back into the typed table."""
    folder = scratch_dir(spark, "bronze")
    write_csv(b.raw_orders(spark, sf), f"{folder}/orders")
    return portable(conform(read_full_load(spark, f"{folder}/orders", ORDERS), ORDERS, b.LOADED))


@query
def csv_change_files(spark, sf):
    """Change files beside the baseline files; neither reader picks up the other's."""
    folder = scratch_dir(spark, "bronze")
    write_csv(b.raw_orders(spark, sf), f"{folder}/orders")
    write_csv(b.raw_batch_1(spark, sf).drop("_cdc_seq"), f"{folder}/orders/cdc")
    baseline = conform(read_full_load(spark, f"{folder}/orders", ORDERS), ORDERS, b.LOADED)
    changes = read_change_files(spark, f"{folder}/orders/cdc", ORDERS)
    return portable(staged_changes(baseline, changes, ORDERS, b.BATCH_1))


@query
def rejected_lines(spark, sf):
    """Documents in CSV files of which some lines are broken: what loads, and what is kept apart."""
    folder = scratch_dir(spark, "broken")
    k = F.col("doc_id")
    # Line breaks would need multi-line reading, a file a task.
    flat = F.translate(F.coalesce("text", F.lit("")), "\r\n", "  ")
    quoted = F.concat(F.lit('"'), F.replace(flat, F.lit('"'), F.lit('""')), F.lit('"'))
    line = (
        F.when(k % 7 == 1, F.concat_ws(",", k, F.concat(F.lit('"'), "lang"), "source", quoted))  # a quote left open
        .when(k % 7 == 2, F.concat_ws(",", k, "lang", "source", quoted, F.lit("more")))
        .when(k % 7 == 3, F.concat_ws(",", k, "lang"))
        .otherwise(F.concat_ws(",", k, "lang", "source", quoted))
    )
    # Four files, each with its header first.
    files = spark.range(4).select(F.col("id").alias("p"), F.lit("doc_id,lang,source,text").alias("value"), F.lit(0).alias("n"))
    lines = table(spark, sf, "documents").select((k % 4).alias("p"), line.alias("value"), F.lit(1).alias("n"))
    sorted_lines = files.union(lines).repartition("p").sortWithinPartitions("p", "n")
    sorted_lines.select("p", "value").write.partitionBy("p").text(f"{folder}/lines")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("doc_id", "lang", "source", "text")])
    good, bad = read_csv_apart(spark, f"{folder}/lines/*/*.txt", schema)
    loaded = good.select(F.col("doc_id").cast("long"), F.lit(True).alias("loaded"), F.md5("text").alias("digest"))
    from_line = F.regexp_extract("line", "^[0-9]+", 0).cast("long").alias("doc_id")
    return loaded.unionByName(bad.select(from_line, F.lit(False).alias("loaded"), F.md5("line").alias("digest")))


@query
def landed_files(spark, sf):
    """CSV files appended to the landing table of a day."""
    from datetime import date

    folder = scratch_dir(spark, "landing")
    write_csv(b.raw_inventory(spark, sf), f"{folder}/in")
    landed = land(spark, f"{folder}/in", f"{folder}/landed", INVENTORY, date(2026, 1, 1))
    typed = conform(landed, INVENTORY, keep=["_ingest_date", SOURCE_FILE])
    return portable(
        typed.withColumn("has_source", F.col(SOURCE_FILE).endswith(".csv")).drop(SOURCE_FILE)
    )


@query
def replaced_snapshot(spark, sf):
    """A snapshot folder overwritten with rows derived from itself."""
    folder = f"{scratch_dir(spark, 'snapshot')}/portfolios"
    write_csv(b.raw_snapshot(spark, sf, 0), folder)
    rows = read_full_load(spark, folder, PORTFOLIOS)
    replace_snapshot(rows.withColumn("region", F.lit("br ")), folder)
    return portfolio_snapshot(read_full_load(spark, folder, PORTFOLIOS))


@query
def parquet_result(spark, sf):
    """A result written and counted in one pass, then read back."""
    path = f"{scratch_dir(spark, 'result')}/result.parquet"
    n = write_parquet(_orders(spark, sf), path)
    back = spark.read.parquet(path)
    return back.groupBy("status").agg(F.count("*").alias("n_rows")).withColumn(
        "n_written", F.lit(n).cast("bigint")
    )


@query
def table_versions(spark, sf):
    """Row counts of a table's versions after each write."""
    orders = Lakehouse(spark, scratch_dir(spark, "versions")).table("silver.stg_orders")
    orders.overwrite(_staged_orders(spark, sf))
    changes = b.raw_batch_1(spark, sf)
    orders.update(lambda t: staged_changes(t, changes, ORDERS, b.BATCH_1, ("_cdc_seq",)))
    out = None
    for version in orders.versions():
        rows = orders.read(version).agg(
            F.lit(version).cast("bigint").alias("version"), F.count("*").alias("n_rows")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def catalog_names(spark, sf):
    """The dimension read by its qualified and by its bare name."""
    dim = b.dimension(spark, sf, 2)
    session = adhoc.read_only_session(spark, [dim])
    return adhoc.query(
        session,
        "select a.region, a.is_current, count(*) as n_versions "
        "from silver.dim_client_portfolio a join dim_client_portfolio b "
        "on a.portfolio_version_key = b.portfolio_version_key group by 1, 2",
    )


@query
def stream_change_files(spark, sf):
    """Two change files taken in by a file stream, each run again with nothing new."""
    folder = scratch_dir(spark, "stream")
    orders = Lakehouse(spark, f"{folder}/lake").table("silver.stg_orders")
    orders.overwrite(_staged_orders(spark, sf))
    times = iter((b.BATCH_1, b.BATCH_2))
    for raw in (b.raw_batch_1, b.raw_batch_2):
        rows = raw(spark, sf).select(*ORDERS.columns, OP, text_of("_cdc_seq").alias("_cdc_seq"))
        # A key's rows stay in one file, so the files of a batch do not depend on each other.
        write_csv(rows.repartition(3, ORDERS.key), f"{folder}/cdc", mode="append")
        for _ in range(2):  # the second run finds no new file
            stream = apply_change_files(
                spark,
                f"{folder}/cdc",
                ORDERS,
                orders,
                f"{folder}/checkpoint",
                preserve=["ingestion_time"],
                clock=lambda: next(times),
                extra=["_cdc_seq"],
            )
            stream.awaitTermination()
    return portable(orders.read())


@query
def stream_redelivered(spark, sf):
    """Two change files, then the first one's changes again in a later file: each change counts once."""
    folder = scratch_dir(spark, "stream")
    orders = Lakehouse(spark, f"{folder}/lake").table("silver.stg_orders")
    orders.overwrite(_staged_orders(spark, sf))
    times = (b.BATCH_1, b.BATCH_2, "2026-01-09 00:00:00")
    for raw, number, at in zip((b.raw_batch_1, b.raw_batch_2, b.raw_batch_1), "121", times):
        rows = raw(spark, sf).select(*ORDERS.columns, OP, F.lit(number).alias("_cdc_seq"))
        write_csv(rows.repartition(2, ORDERS.key), f"{folder}/cdc", mode="append")
        apply_change_files(
            spark,
            f"{folder}/cdc",
            ORDERS,
            orders,
            f"{folder}/checkpoint",
            preserve=["ingestion_time"],
            clock=lambda at=at: at,
            extra=["_cdc_seq"],
            once_by=[ORDERS.key, "_cdc_seq"],
        ).awaitTermination()
    return portable(orders.read())


@query
def build_two_rounds(spark, sf):
    """The whole build three times: a first load, then a change batch before each later run."""
    folder = scratch_dir(spark, "build")
    lake = Lakehouse(spark, f"{folder}/lake")
    for name, raw in (
        ("orders", b.raw_orders(spark, sf)),
        ("clients", b.raw_clients(spark, sf)),
        ("inventory", b.raw_inventory(spark, sf)),
        ("portfolios", b.raw_snapshot(spark, sf)),
    ):
        write_csv(raw, f"{folder}/bronze/{name}")
    build(lake, f"{folder}/bronze", datetime.fromisoformat(b.LOADED), mode="run")
    for raw, at in ((b.raw_batch_1, b.BATCH_1), (b.raw_batch_2, b.BATCH_2)):
        rows = raw(spark, sf).select(*ORDERS.columns, OP).repartition(3, ORDERS.key)
        write_csv(rows, f"{folder}/bronze/orders/cdc", mode="append")
        build(lake, f"{folder}/bronze", datetime.fromisoformat(at), mode="run")
    return portable(lake.table("silver.stg_orders").read())


@query
def stream_backlog(spark, sf):
    """Both change files waiting: taken in one after the other, the table written once."""
    folder = scratch_dir(spark, "stream")
    orders = Lakehouse(spark, f"{folder}/lake").table("silver.stg_orders")
    orders.overwrite(_staged_orders(spark, sf))
    for name, raw in (("1", b.raw_batch_1), ("2", b.raw_batch_2)):
        rows = raw(spark, sf).select(*ORDERS.columns, OP, F.lit(name).alias("_cdc_seq"))
        write_csv(rows, f"{folder}/cdc/{name}")
    changes = spark.readStream.schema(
        ORDERS.raw_schema(changes=True).add("_cdc_seq", "string")
    )
    stream = merge_stream(
        changes.option("header", "true").csv(f"{folder}/cdc/*"),
        ORDERS,
        orders,
        f"{folder}/checkpoint",
        preserve=["ingestion_time"],
        clock=lambda: b.BATCH_2,
        sequence="_cdc_seq",
    )
    stream.awaitTermination()
    return portable(orders.read())


@query
def stream_snapshot_files(spark, sf):
    """Four snapshots of several files taken in by a stream, one dimension round each."""
    folder = scratch_dir(spark, "stream")
    dim = Lakehouse(spark, f"{folder}/lake").history("silver.dim_client_portfolio")
    times = dict(b.SNAPSHOT_TIMES)
    for n in range(4):
        write_csv(b.raw_snapshot(spark, sf, n).repartition(3), f"{folder}/in/{n}")
        apply_snapshot_files(
            spark,
            f"{folder}/in",
            PORTFOLIOS,
            dim,
            f"{folder}/checkpoint",
            portfolio_versions,
            batch_ts=lambda rows, n=n: times[n],
            by_folder=True,
        ).awaitTermination()
    return portable(dim.read())


@query
def stream_snapshot_backlog(spark, sf):
    """A first snapshot, then three that wait together: taken in with one write of the dimension."""
    folder = scratch_dir(spark, "stream")
    dim = Lakehouse(spark, f"{folder}/lake").history("silver.dim_client_portfolio")

    def take_in():
        apply_snapshot_files(
            spark,
            f"{folder}/in",
            PORTFOLIOS,
            dim,
            f"{folder}/checkpoint",
            portfolio_versions,
            # Each snapshot's folder is named after its number.
            batch_ts=lambda rows: b.SNAPSHOT_TIMES[int(rows.select(f"{ARRIVAL}.file_path").first()[0].split("/")[-2])],
            by_folder=True,
        ).awaitTermination()

    write_csv(b.raw_snapshot(spark, sf, 0).repartition(3), f"{folder}/in/0")
    take_in()
    for n in b.SNAPSHOT_TIMES:
        write_csv(b.raw_snapshot(spark, sf, n).repartition(3), f"{folder}/in/{n}")
    take_in()
    return portable(dim.read())


__all__ = ["QUERIES"]
