"""The sample of the pipeline: baseline, one change round, and the same round again."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from support import rows, write_file

from strata.plans import models as m
from strata.plans.pipeline import CheckFailed, build
from strata.schema import CLIENTS, INVENTORY, ORDERS, PORTFOLIOS
from strata.sources.tables import Lakehouse

# The sample rows whose results are known.
SAMPLE = {
    ORDERS: [
        "1,101,1,2,2026-01-05,399.80,Paid",
        "2,102,2,10,2026-01-05,45.00,paid",
        "3,103,3,1,2026-01-06,29.99,PENDING",
        "4,104,4,3,2026-01-06,44.25,cancelled",
        "5,,5,1,2026-01-07,59.00,paid",
    ],
    CLIENTS: [
        "101,Client 101,client101@example.com,BR,2022-03-01,retail",
        "102,Client 102,client102@example.com,US,2022-04-15,Retail",
        "103,Client 103,client103@example.com,PT,2023-01-10,wholesale",
        "104,Client 104,,AR,2023-06-20,VIP",
        "105,Client 105,client105@example.com,MX,2024-02-05,vip",
    ],
    INVENTORY: [
        "1,1,Electronics,120,199.90,2026-01-01,active",
        "2,2,Grocery,300,4.50,2026-01-03,ACTIVE",
        "3,1,Apparel,80,29.99,2026-01-02,Active",
        "4,3,Toys,50,14.75,2025-12-20,discontinued",
        "5,2,Home,200,59.00,2026-01-04,",
    ],
    PORTFOLIOS: [
        "101,1,Portfolio 1,1,Manager 1,br,Platinum",
        "102,1,Portfolio 1,1,Manager 1,BR,platinum",
        "103,2,Portfolio 2,2,Manager 2,us,GOLD",
        "104,2,Portfolio 2,2,Manager 2,US,gold",
        "105,3,Portfolio 3,3,Manager 3,PT,Silver",
        "106,3,Portfolio 3,3,Manager 3,pt,silver",
    ],
}
# Sample change rows that the golden results follow from.
CHANGES = {
    ORDERS: [
        "1,101,1,3,2026-01-08,599.70,Paid,U",
        "2,102,2,10,2026-01-05,45.00,paid,D",
        "4,104,4,3,2026-01-06,44.25,cancelled,D",
        "6,105,3,2,2026-01-09,59.98,pending,I",
    ],
    CLIENTS: [
        "102,Client 102,client102@example.com,US,2022-04-15,VIP,U",
        "104,Client 104,,AR,2023-06-20,VIP,D",
        "106,Client 106,client106@example.com,BR,2026-01-01,retail,I",
    ],
    INVENTORY: [
        "1,1,Electronics,80,199.90,2026-01-10,active,U",
        "4,3,Toys,50,14.75,2025-12-20,discontinued,D",
        "6,2,Home,150,89.00,2026-01-11,active,I",
    ],
}
RUNS = [datetime(2026, 2, d) for d in (1, 2, 3)]


@pytest.fixture
def bronze(tmp_path):
    folder = tmp_path / "bronze"
    for entity, lines in SAMPLE.items():
        write_file(folder / entity.name, "sample.csv", ",".join(entity.columns), *lines)
    return folder


def add_changes(bronze, name="batch.csv"):
    for entity, lines in CHANGES.items():
        header = ",".join([*entity.columns, "_cdc_op"])
        write_file(bronze / entity.name / "cdc", name, header, *lines)


def gold(lake):
    cols = [
        "region", "tier", "portfolio_id", "order_count", "paid_order_count", "active_customers",
        "paid_revenue", "pending_amount", "refunded_amount", "avg_paid_order_value",
    ]
    numbers = [F.col(c).cast("double") if c.endswith(("revenue", "amount")) else F.col(c) for c in cols]
    return rows(lake.table(m.FCT_REVENUE).read().select(*numbers))


def counts(lake):
    tables = [lake.table(n).read().count() for n in (m.STG_ORDERS, m.STG_CLIENTS, m.STG_INVENTORY)]
    return [*tables, lake.history(m.DIM_PORTFOLIO).read().count()]


def test_three_runs_over_the_sample(spark, tmp_path, bronze):
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    report = build(lake, str(bronze), RUNS[0])
    assert len(report) == len(m.RULES) and not any(r["failures"] for r in report)
    assert counts(lake) == [5, 5, 5, 6]
    assert gold(lake) == [
        ("BR", "platinum", 1, 2, 2, 2, 444.80, None, None, 222.40),
        ("US", "gold", 2, 2, 0, 2, None, 29.99, None, None),
    ]

    after = [
        ("BR", "platinum", 1, 1, 1, 1, 599.70, None, None, 599.70),
        ("PT", "silver", 3, 1, 0, 1, None, 59.98, None, None),
        ("US", "gold", 2, 1, 0, 1, None, 29.99, None, None),
    ]
    seen = []
    for at in RUNS[1:]:
        add_changes(bronze, f"batch_{at.day}.csv")  # the same changes arrive again
        build(lake, str(bronze), at)
        assert counts(lake) == [4, 5, 5, 6]
        assert gold(lake) == after
        orders = lake.table(m.STG_ORDERS).read()
        seen.append(rows(orders.drop("last_updated_time")))
        loaded = dict(rows(orders.select("order_id", F.dayofmonth("ingestion_time"))))
        assert loaded == {1: 1, 3: 1, 5: 1, 6: 2}
        touched = dict(rows(orders.select("order_id", F.dayofmonth("last_updated_time"))))
        assert touched == {1: at.day, 3: 1, 5: 1, 6: at.day}
    assert seen[0] == seen[1]
    segment = lake.table(m.STG_CLIENTS).read().filter("customer_id = 102").first()["segment"]
    on_hand = lake.table(m.STG_INVENTORY).read().filter("product_id = 1").first()["quantity_on_hand"]
    assert (segment, on_hand) == ("vip", 80)


def test_history_of_attribution_is_not_rewritten(spark, tmp_path, bronze):
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    build(lake, str(bronze), RUNS[0])
    before = gold(lake)
    moved = SAMPLE[PORTFOLIOS].copy()
    moved[0] = "101,2,Portfolio 2,2,Manager 2,us,gold"
    write_file(bronze / "portfolios", "sample.csv", ",".join(PORTFOLIOS.columns), *moved)
    build(lake, str(bronze), RUNS[1])
    assert gold(lake) == before
    assert counts(lake)[3] == 7


def test_failed_check_stops_the_build_before_gold(spark, tmp_path, bronze):
    header = ",".join(ORDERS.columns)
    write_file(bronze / "orders", "sample.csv", header, "1,999,1,1,2026-01-05,1.00,lost")
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    with pytest.raises(CheckFailed, match="accepted_values.*status: 1"):
        build(lake, str(bronze), RUNS[0])
    assert not lake.table(m.FCT_REVENUE).exists()


def test_the_report_of_a_build_is_that_of_the_suite(spark, tmp_path, bronze):
    """Row rules are judged by the writes: a load, a merge of change files, a round, a rebuild."""
    from strata.operators.quality import run_suite
    from strata.plans.pipeline import _reader

    def plain(report):
        return sorted((r["rule"], r["table_name"], r["column_name"], r["failures"]) for r in report)

    lake = Lakehouse(spark, str(tmp_path / "lake"))
    for n, at in enumerate(RUNS):
        if n:
            add_changes(bronze, f"batch_{at.day}.csv")
        report = build(lake, str(bronze), at)
        tables = {t: _reader(lake, t) for t in (m.STG_ORDERS, m.STG_CLIENTS, m.STG_INVENTORY, m.DIM_PORTFOLIO, m.FCT_REVENUE)}
        assert plain(report) == plain(run_suite(tables, m.RULES).collect())


def test_a_write_that_breaks_a_row_rule_is_not_shown(spark, tmp_path, bronze):
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    build(lake, str(bronze), RUNS[0])
    before = rows(lake.table(m.STG_ORDERS).read())
    header = ",".join([*ORDERS.columns, "_cdc_op"])
    write_file(bronze / "orders" / "cdc", "bad.csv", header, "77,101,1,1,2026-01-05,1.00,lost,I")
    with pytest.raises(CheckFailed, match="accepted_values.*status: 1"):
        build(lake, str(bronze), RUNS[1])
    assert rows(lake.table(m.STG_ORDERS).read()) == before and lake.table(m.STG_ORDERS).versions() == [0]
    # The file was not taken in: put right, it is.
    write_file(bronze / "orders" / "cdc", "bad.csv", header, "77,101,1,1,2026-01-05,1.00,paid,I")
    build(lake, str(bronze), RUNS[2])
    assert lake.table(m.STG_ORDERS).read().filter("order_id = 77").count() == 1


def test_watched_rows_are_counted_as_the_suite_counts_them(spark, tmp_path):
    from strata.operators.quality import Accepted, CurrentFlag, NotNull, Unique, run_suite, watched

    df = spark.sql(
        "select * from values (1, 'a', true, null), (null, 'b', true, timestamp_ntz'2020-01-01'), (3, null, null, null)"
        " as t(id, kind, is_current, valid_to)"
    )
    rules = [NotNull("t", "id"), Accepted("t", "kind", ("a",)), CurrentFlag("t"), Unique("t", "id")]
    seen, report = watched(df, rules)
    seen.write.parquet(str(tmp_path / "t"))
    assert rows(run_suite({"t": df}, rules[:3])) == sorted(map(tuple, report()), key=repr)
    assert [r["failures"] for r in report()] == [1, 1, 1]
    same, nothing = watched(df, [Unique("t", "id")])
    assert same is df and nothing() == []
    table = Lakehouse(spark, str(tmp_path / "lake")).table("silver.t")
    with pytest.raises(CheckFailed):
        table.overwrite(df, rules=rules)
    assert not table.exists() and [r["failures"] for r in table.report] == [1, 1, 1]


def test_run_skips_checks_and_test_only_checks(spark, tmp_path, bronze):
    header = ",".join(ORDERS.columns)
    write_file(bronze / "orders", "sample.csv", header, "1,999,1,1,2026-01-05,1.00,lost")
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    assert build(lake, str(bronze), RUNS[0], mode="run") == []
    report = build(lake, str(bronze), RUNS[0], mode="test")
    failed = {(r["rule"], r["column_name"]): r["failures"] for r in report if r["failures"]}
    assert failed == {("accepted_values", "status"): 1, ("relationships", "customer_id"): 1}
    with pytest.raises(ValueError):
        build(lake, str(bronze), mode="deploy")


def test_eight_rounds_keep_the_population(spark, tmp_path):
    """Customers move on round after round; the open versions stay one per customer."""
    from strata.operators.history import scd2_step
    from strata.operators.quality import assert_population, overlap_failures, unique_failures

    lake = Lakehouse(spark, str(tmp_path / "lake"))
    dim = lake.history(m.DIM_PORTFOLIO)

    def raw(n):
        k, text = F.col("id"), lambda c: c.cast("string")
        p = (k + F.when(k % 5 < n % 5, n).otherwise(0)) % 7
        return spark.range(200).select(
            text(k).alias("customer_id"),
            text(p).alias("portfolio_id"),
            F.concat(F.lit("P"), text(p)).alias("portfolio_name"),
            text(p % 3).alias("manager_id"),
            F.lit("M").alias("manager_name"),
            F.lit("br").alias("region"),
            F.lit("gold").alias("tier"),
        )

    dim.overwrite(m.portfolio_versions(raw(0)))
    for n in range(1, 9):
        versions = m.portfolio_versions(raw(n), f"2020-0{n}-01 00:00:00")
        dim.advance(lambda o, v=versions: scd2_step(o, v, "customer_id"))
        assert_population(m.portfolio_snapshot(raw(n)), dim.open_versions(), "customer_id")
    assert unique_failures(dim.read(), "customer_id", "is_current").count() == 0
    assert overlap_failures(dim.read(), "customer_id").count() == 0
    assert unique_failures(dim.read(), m.VERSION_KEY).count() == 0
