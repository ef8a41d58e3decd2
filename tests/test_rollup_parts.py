"""Gold from deltas against the full rebuild, bitmaps against distinct counts, ids that stay."""

import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from support import rows, same

from strata.operators.distinct import count_members, distinct_bitmaps, merge_bitmaps
from strata.operators.hierarchy import dense_index, extend_index
from strata.operators.history import as_versions, scd2_apply, scd2_initial
from strata.operators.rollup import OWNER, portfolio_revenue
from strata.operators.rollup_parts import fold_parts, moved_since, revenue_delta, revenue_of_parts, revenue_parts
from strata.plans.revenue import RevenueLedger

ORDER = "order_id long, customer_id long, order_date date, amount decimal(18,2), status string"
KEYS = ["region", "tier", "portfolio_id", "manager_id"]


def order(spark, data):
    return spark.createDataFrame(data, ORDER).withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def make_orders(rng, ids):
    from decimal import Decimal

    return {
        i: (
            i,
            rng.choice([None, *range(8)]),
            rng.choice([None, *[date(2020, m, d) for m in (1, 2, 3, 4) for d in (1, 15, 28)]]),
            rng.choice([None, Decimal(rng.randrange(1, 10_000)) / 100]),
            rng.choice(["paid", "pending", "refunded", "cancelled", None]),
        )
        for i in ids
    }


def snapshot(spark, owner):
    data = [(k, f"r{p % 2}", "gold", p, f"P{p}", p * 10, f"M{p}") for k, p in owner.items()]
    return spark.createDataFrame(
        data,
        "customer_id long, region string, tier string, portfolio_id long, portfolio_name string, manager_id long, manager_name string",
    )


def files(root):
    return {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def month_of_file(path):
    return next(p.split("=")[1] for p in path.parts if p.startswith("order_month="))


def test_parts_give_the_rollup(spark):
    orders = order(spark, list(make_orders(random.Random(1), range(300)).values()))
    dim = scd2_initial(snapshot(spark, {k: k % 3 for k in range(7)}), "customer_id", KEYS)
    rebuilt = portfolio_revenue(orders, dim)
    same(revenue_of_parts(fold_parts(revenue_parts(orders, dim))).select(rebuilt.columns), rebuilt)
    assert [f.dataType for f in revenue_of_parts(revenue_parts(orders, dim)).select(rebuilt.columns).schema] == [
        f.dataType for f in rebuilt.schema
    ]


def test_batches_and_a_dimension_round_equal_the_rebuild(spark, tmp_path):
    rng = random.Random(2)
    state = make_orders(rng, range(200))
    dim = scd2_initial(snapshot(spark, {k: k % 3 for k in range(8)}), "customer_id", KEYS)
    ledger = RevenueLedger(spark, str(tmp_path))
    ledger.load(order(spark, list(state.values())), dim)
    same(ledger.read().select(*_columns(spark, state, dim)), portfolio_revenue(order(spark, list(state.values())), dim))
    for n in (1, 2):
        before = order(spark, list(state.values()))
        changed = rng.sample(sorted(state), 30)
        state = dict(state)
        for i in changed[:15]:
            del state[i]
        state |= make_orders(rng, changed[15:] + list(range(1000 * n, 1000 * n + 10)))
        after = order(spark, list(state.values()))
        keys = spark.createDataFrame([(i,) for i in changed + list(range(1000 * n, 1000 * n + 10)) + [77_777]], "order_id long")
        ledger.apply(n, revenue_delta(before, after, dim, keys=keys))
        same(ledger.read().select(*_columns(spark, state, dim)), portfolio_revenue(after, dim))
    orders = order(spark, list(state.values()))
    at = "2020-02-20 00:00:00"
    new = as_versions(snapshot(spark, {k: k % 2 + 1 for k in range(1, 9)}), "customer_id", KEYS, at)
    moved = scd2_apply(dim, new, "customer_id", at)
    delta = revenue_delta(orders, orders, dim, moved, moved=moved_since(moved, at))
    months = ledger.apply(3, delta)
    assert date(2020, 1, 1) not in months  # orders before the round keep their owner
    rebuilt = portfolio_revenue(orders, moved)
    same(ledger.read().select(rebuilt.columns), rebuilt)
    # A batch that is delivered again changes nothing, and folding keeps the result.
    ledger.apply(3, delta)
    same(ledger.read().select(rebuilt.columns), rebuilt)
    ledger.fold(3)
    same(revenue_of_parts(fold_parts(ledger.parts())).select(rebuilt.columns), rebuilt)
    fourth = order(spark, [(5000, 1, date(2020, 3, 1), None, "paid")])
    ledger.apply(4, revenue_delta(orders, orders.union(fourth), moved, keys=fourth))
    same(ledger.read().select(rebuilt.columns), portfolio_revenue(orders.union(fourth), moved))


def _columns(spark, state, dim):
    return portfolio_revenue(order(spark, list(state.values())), dim).columns


def test_untouched_months_are_not_written(spark, tmp_path):
    data = [(i, i % 3, date(2020, i % 4 + 1, 3), None, "paid") for i in range(24)]
    dim = scd2_initial(snapshot(spark, {0: 1, 1: 1, 2: 2}), "customer_id", KEYS)
    orders = order(spark, data)
    ledger = RevenueLedger(spark, str(tmp_path))
    ledger.load(orders, dim)
    old = files(tmp_path / "gold")
    # All orders of February go: its groups vanish, and with them nothing else.
    february = orders.filter(F.col("order_date") == date(2020, 2, 3))
    after = orders.exceptAll(february)
    assert ledger.apply(1, revenue_delta(orders, after, dim, keys=february)) == [date(2020, 2, 1)]
    new = files(tmp_path / "gold")
    assert {month_of_file(p) for p in set(old) ^ set(new)} == {"2020-02-01"}
    assert all(new[p] == t for p, t in old.items() if p in new)
    assert rows(ledger.read().select("order_month").distinct()) == [(date(2020, m, 1),) for m in (1, 3, 4)]
    assert ledger.apply(2, revenue_delta(after, after, dim, keys=orders)) == []  # what changed nothing
    assert files(tmp_path / "gold") == new
    # The month comes back.
    ledger.apply(3, revenue_delta(after, orders, dim, keys=february))
    same(ledger.read().select(portfolio_revenue(orders, dim).columns), portfolio_revenue(orders, dim))


def test_only_touched_months_are_read(spark, tmp_path):
    dim = scd2_initial(snapshot(spark, {0: 1}), "customer_id", KEYS)
    ledger = RevenueLedger(spark, str(tmp_path))
    ledger.load(order(spark, [(i, 0, date(2020, i % 4 + 1, 3), None, "paid") for i in range(8)]), dim)
    assert {month_of_file(Path(p)) for p in ledger.parts([date(2020, 3, 1)]).inputFiles()} >= {"2020-03-01"}
    plan = ledger.parts([date(2020, 3, 1)])._jdf.queryExecution().executedPlan().toString()
    assert "order_month" in plan.split("PartitionFilters")[1].splitlines()[0]


def test_batches_count_from_1(spark, tmp_path):
    with pytest.raises(ValueError):
        RevenueLedger(spark, str(tmp_path)).apply(0, spark.range(0))


def test_retracted_sums_are_null_again(spark):
    from decimal import Decimal

    dim = scd2_initial(snapshot(spark, {1: 1}), "customer_id", KEYS)
    one = order(spark, [(1, 1, date(2020, 1, 1), Decimal("5.00"), "paid"), (2, 1, date(2020, 1, 2), Decimal("0.00"), "pending")])
    two = order(spark, [(1, 1, date(2020, 1, 1), None, "paid"), (2, 1, date(2020, 1, 2), Decimal("0.00"), "pending")])
    parts = revenue_parts(one, dim).union(revenue_delta(one, two, dim, keys=one))
    got = revenue_of_parts(fold_parts(parts)).first()
    assert (got["paid_revenue"], got["pending_amount"], got["paid_order_count"]) == (None, Decimal("0.00"), 1)
    assert got["avg_paid_order_value"] is None and len(OWNER) == 6


# -- distinct members and their numbers -----------------------------------
def test_bitmaps_merge_to_distinct_counts(spark):
    rng = random.Random(4)
    data = [(rng.choice("abc"), rng.randrange(12), rng.choice([None, *range(1, 90_000)])) for _ in range(3000)]
    facts = spark.createDataFrame(data, "g string, m int, who long")
    months = distinct_bitmaps(facts, ["g", "m"], "who")
    for level, by in ((["g", "m"], ["g", "m"]), (["g", (F.col("m") / 6).cast("int").alias("half")], ["g", "half"])):
        want = facts.filter("who is not null").withColumn("half", (F.col("m") / 6).cast("int"))
        want = want.groupBy(*by).agg(F.count_distinct("who").alias("members"))
        same(count_members(months, level), want)
        same(count_members(merge_bitmaps(months, level), by), want)
    assert count_members(distinct_bitmaps(facts.limit(0), ["g"], "who"), ["g"]).count() == 0


def test_numbers_stay_and_have_no_gaps(spark):
    def ids(*values):
        return spark.createDataFrame([(v,) for v in values], "who string")

    first = dense_index(ids("m", "c", "m", "x"), "who")
    second = extend_index(first, ids("a", "c", None, "z", None), "who")
    third = extend_index(second, ids("b", None, "a"), "who")
    got = {r["who"]: r["idx"] for r in third.collect()}
    assert got == {"c": 1, "m": 2, "x": 3, "a": 4, "z": 5, None: 6, "b": 7}
    same(extend_index(third, ids("b"), "who"), third)
    assert extend_index(first.limit(0), ids("q"), "who").collect()[0]["idx"] == 1
