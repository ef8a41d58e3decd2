"""Timings of the headline queries; prints one JSON line.

``BENCH_SF_DIR``   the tables to read (default sf0.1)
``BENCH_CPUS``     local cores (default 8)
``BENCH_REPEATS``  timed runs per query after one warm-up; the median counts
``BENCH_SCALE=0``  leaves out the scale run: 5 M orders, 100 k clients and 1 M
                   products made by Spark in a scratch folder (not timed), then
                   loaded, changed, versioned, rolled up and checked, each once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.session import build_session, scratch_dir  # noqa: E402

HEADLINE = (
    "stg_orders_baseline",
    "cdc_merge_orders",
    "cdc_merge_two_batches",
    "dim_after_snap3",
    "dim_backlog",
    "pit_orders",
    "pit_orders_slots",
    "gold_portfolio_revenue",
    "gold_after_changes",
    "q_suite",
    "dedup_lineitem",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def headline(spark: SparkSession, sf: str, repeats: int) -> tuple[dict, dict]:
    from workload.queries import QUERIES

    first, warm = {}, {}
    for name in HEADLINE:
        query = QUERIES[name]
        first[name] = round(timed(lambda: run(query(spark, sf))), 3)
        runs = [timed(lambda: run(query(spark, sf))) for _ in range(repeats)]
        warm[name] = round(statistics.median(runs), 3)
    for name, seconds in joins(spark, sf, repeats).items():
        first[name], warm[name] = seconds
    return first, warm


def joins(spark: SparkSession, sf: str, repeats: int) -> dict[str, tuple[float, float]]:
    """The point-in-time join alone, on orders and a dimension that are stored before."""
    from strata.operators.attribution import point_in_time_join
    from workload import bindings as b
    from workload.queries import _orders

    folder = scratch_dir(spark, "stored")
    _orders(spark, sf).write.parquet(f"{folder}/orders")
    b.dimension(spark, sf, 3).read().write.parquet(f"{folder}/versions")
    orders, versions = (spark.read.parquet(f"{folder}/{t}") for t in ("orders", "versions"))
    out = {}
    for method in ("range", "slots", "sweep"):

        def join(method=method):
            run(point_in_time_join(orders, versions, "customer_id", "order_date", ["portfolio_id"], method=method))

        once = round(timed(join), 3)
        out[f"join_stored_{method}"] = (once, round(statistics.median(timed(join) for _ in range(repeats)), 3))
    return out


def make_sources(spark: SparkSession, folder: str, orders: int, clients: int, products: int) -> None:
    """Raw CSV sources of the scale run, every value drawn from the row's key."""

    def draw(salt: int, n: int):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))

    def pick(salt: int, values: str):
        listed = F.split(F.lit(values), ",")
        return F.element_at(listed, (draw(salt, values.count(",") + 1) + 1).cast("int"))

    def money(salt: int, top: int):
        return (draw(salt, top * 100) / 100 + 1).cast("decimal(18,2)")

    def write(df: DataFrame, name: str) -> None:
        df.write.option("header", "true").csv(f"{folder}/{name}")

    day = F.date_add(F.lit("2024-01-01").cast("date"), draw(1, 990).cast("int"))
    ids = spark.range(1, orders + 1)
    order = {
        "order_id": F.col("id"),
        "customer_id": F.when(draw(2, 200) > 0, draw(3, clients) + 1),
        "product_id": draw(4, products) + 1,
        "quantity": draw(5, 12) + 1,
        "order_date": day,
        "amount": money(6, 1000),
        "status": pick(7, "Paid, paid ,PAID,Pending,refunded,CANCELLED"),
    }
    write(ids.select(*[v.alias(k) for k, v in order.items()]), "orders")
    kind = draw(17, 1000)
    changed = order | {
        "amount": money(18, 2000),
        "status": pick(19, "paid,cancelled,refunded"),
        "_cdc_op": F.when(kind < 5, "D").otherwise("U"),
    }
    write(ids.filter(kind < 25).select(*[v.alias(k) for k, v in changed.items()]), "orders/cdc")

    people = spark.range(1, clients + 1)
    client = {
        "customer_id": F.col("id"),
        "name": F.concat(F.lit(" Account "), "id"),
        "email": F.concat(F.lit("Account."), "id", F.lit("@mail.test ")),
        "country": pick(8, "de,fr , it,nl,se"),
        "signup_date": day,
        "segment": pick(9, "retail,Wholesale,VIP "),
    }
    write(people.select(*[v.alias(k) for k, v in client.items()]), "clients")
    product = {
        "product_id": F.col("id"),
        "warehouse_id": draw(10, 20) + 1,
        "category": pick(11, "tools,garden,paint ,timber"),
        "quantity_on_hand": draw(12, 900),
        "unit_cost": money(13, 400),
        "last_restock_date": day,
        "status": pick(14, "active,Active ,discontinued"),
    }
    things = spark.range(1, products + 1)
    write(things.select(*[v.alias(k) for k, v in product.items()]), "inventory")

    for later, name in ((False, "portfolios"), (True, "portfolios_next")):
        # Later, 3 % of the clients have moved on and every 20th portfolio has a new manager.
        start = draw(15, 500) + 1
        moved = F.when((draw(16, 100) < 3) & F.lit(later), start % 500 + 1).otherwise(start)
        p = F.col("p")
        manager = p % 50 + F.when((p % 20 == 0) & F.lit(later), 100).otherwise(0)
        portfolio = {
            "customer_id": F.col("id"),
            "portfolio_id": p,
            "portfolio_name": F.concat(F.lit("Book "), p),
            "manager_id": manager,
            "manager_name": F.concat(F.lit("Desk "), manager),
            "region": F.element_at(F.split(F.lit("north,east,south,west"), ","), (p % 4 + 1).cast("int")),
            "tier": F.element_at(F.split(F.lit("gold,Silver ,bronze"), ","), (p % 3 + 1).cast("int")),
        }
        write(people.withColumn("p", moved).select(*[v.alias(k) for k, v in portfolio.items()]), name)


def scale_run(spark: SparkSession) -> dict:
    """Load, change, version, roll up and check data of the published size."""
    from strata.operators.history import scd2_step
    from strata.operators.quality import run_suite
    from strata.plans import models as m
    from strata.schema import PORTFOLIOS
    from strata.sources.files import read_change_files, read_full_load
    from strata.sources.tables import Lakehouse

    folder = scratch_dir(spark, "scale")
    make_sources(spark, folder, 5_000_000, 100_000, 1_000_000)
    lake = Lakehouse(spark, f"{folder}/lake")
    dim = lake.history(m.DIM_PORTFOLIO)
    at, later = "2026-10-01 00:00:00", "2026-10-02 00:00:00"

    def load() -> None:
        for name, entity in m.STAGED.items():
            raw = read_full_load(spark, f"{folder}/{entity.name}", entity)
            lake.table(name).overwrite(m.staged_baseline(raw, entity, at))

    def change() -> None:
        entity = m.STAGED[m.STG_ORDERS]
        raw = read_change_files(spark, f"{folder}/orders/cdc", entity)
        lake.table(m.STG_ORDERS).update(lambda t: m.staged_changes(t, raw, entity, later))

    def gold_and_checks() -> None:
        orders = lake.table(m.STG_ORDERS).read()
        lake.table(m.FCT_REVENUE).overwrite(m.fct_portfolio_revenue(orders, dim.read(), later))
        tables = {name: lake.table(name).read() for name in (*m.STAGED, m.FCT_REVENUE)}
        tables[m.DIM_PORTFOLIO] = dim.read()
        rules = [r for r in m.RULES if r.table in (m.DIM_PORTFOLIO, m.FCT_REVENUE)]
        failed = [r for r in run_suite(tables, rules).collect() if r["failures"]]
        if failed:
            raise RuntimeError(str(failed))

    def first_dimension() -> None:
        raw = read_full_load(spark, f"{folder}/portfolios", PORTFOLIOS)
        dim.overwrite(m.portfolio_versions(raw))
        gold_and_checks()

    def next_dimension() -> None:
        raw = read_full_load(spark, f"{folder}/portfolios_next", PORTFOLIOS)
        versions = m.portfolio_versions(raw, "2026-01-01 12:00:00")
        dim.advance(lambda t: scd2_step(t, versions, PORTFOLIOS.key))
        gold_and_checks()

    seconds = {
        "load_3_silver_tables": round(timed(load), 2),
        "change_batch_125k_on_5m": round(timed(change), 2),
        "scd2_first_load_gold_checks": round(timed(first_dimension), 2),
        "scd2_apply_gold_checks": round(timed(next_dimension), 2),
    }
    versions = dim.read()
    sizes = {
        "orders": lake.table(m.STG_ORDERS).read().count(),
        "versions": versions.count(),
        "open_versions": versions.filter("is_current").count(),
        "gold_rows": lake.table(m.FCT_REVENUE).read().count(),
    }
    return {"seconds": seconds, "rows": sizes}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    first, warm = headline(spark, sf, repeats)
    out = {
        "metric": "headline queries, warm median",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "first_run": first,
        "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
    }
    if os.environ.get("BENCH_SCALE", "1") == "1":
        out["scale_run"] = scale_run(spark)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
