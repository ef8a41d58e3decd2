from datetime import date, datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from support import final_plan, plan_of, rows, same

from strata.operators.attribution import (
    attribution_shift,
    current_join,
    point_in_time_join,
)
from strata.operators.history import (
    ControlColumns,
    as_versions,
    changed_keys,
    scd2_apply,
    scd2_as_of,
    scd2_initial,
)
from strata.operators.quality import (
    current_flag_failures,
    overlap_failures,
    unique_failures,
    version_growth,
)
from strata.plans.models import portfolio_snapshot, portfolio_versions
from strata.schema import PORTFOLIOS

SNAP = "k long, a string, b string, name string"
TRACKED = ["a", "b"]
T1, T2, T3 = "2020-01-01 12:00:00", "2020-02-01 12:00:00", "2020-03-01 12:00:00"


def snap(spark, *data):
    return spark.createDataFrame(list(data), SNAP)


def history(spark, first, *later):
    dim = scd2_initial(snap(spark, *first), "k", TRACKED)
    for at, data in later:
        dim = scd2_apply(dim, as_versions(snap(spark, *data), "k", TRACKED, at), "k", at)
    return dim


def spans(dim):
    picked = dim.select(
        "k", "a", F.col("valid_from").cast("string"), F.col("valid_to").cast("string"), "is_current"
    )
    return rows(picked)


EPOCH = "1900-01-01 00:00:00"
X, Y = (1, "x", "p", "n"), (1, "y", "p", "n")


def test_first_load_opens_in_1900(spark):
    assert spans(history(spark, [X])) == [(1, "x", EPOCH, None, True)]


def test_change_closes_and_opens_at_the_same_instant(spark):
    assert spans(history(spark, [X], (T1, [Y]))) == [
        (1, "x", EPOCH, T1, False),
        (1, "y", T1, None, True),
    ]


def test_untracked_column_opens_no_version_and_stays_frozen(spark):
    dim = history(spark, [X], (T1, [(1, "x", "p", "renamed")]))
    assert rows(dim.select("k", "name", "is_current")) == [(1, "n", True)]


def test_running_again_adds_nothing(spark):
    once = history(spark, [X], (T1, [Y]))
    same(history(spark, [X], (T1, [Y]), (T2, [Y])), once)


def test_key_leaves_and_returns_with_a_gap(spark):
    other = (2, "x", "p", "n")
    dim = history(spark, [X, other], (T1, [other]), (T2, [X, other]))
    assert spans(dim.filter("k = 1")) == [(1, "x", EPOCH, T1, False), (1, "x", T2, None, True)]
    assert overlap_failures(dim, "k").count() == 0


def test_empty_snapshot_closes_everything(spark):
    dim = history(spark, [X, (2, "x", "p", "n")], (T1, []))
    assert {r[4] for r in spans(dim)} == {False}


def test_batch_time_defaults_to_the_snapshot_start(spark):
    dim = scd2_initial(snap(spark, X), "k", TRACKED)
    out = scd2_apply(dim, as_versions(snap(spark, Y), "k", TRACKED, T1), "k")
    assert spans(out) == [(1, "x", EPOCH, T1, False), (1, "y", T1, None, True)]


def test_empty_snapshot_without_a_time_closes_at_the_present(spark):
    dim = scd2_initial(snap(spark, X), "k", TRACKED)
    before = datetime.now(timezone.utc).replace(tzinfo=None)
    out = scd2_apply(dim, as_versions(snap(spark), "k", TRACKED, T1), "k").first()
    assert not out["is_current"] and out["valid_to"] >= before


def test_nulls_in_different_columns_collide_unless_marked(spark):
    old, new = (1, None, "v", "n"), (1, "v", None, "n")
    assert len(spans(history(spark, [old], (T1, [new])))) == 1
    marked = lambda data, at: as_versions(snap(spark, data), "k", TRACKED, at, null_token="~")
    assert scd2_apply(marked(old, EPOCH), marked(new, T1), "k", T1).count() == 2


def test_control_column_names(spark):
    names = ControlColumns("h", "since", "until", "live")
    dim = as_versions(snap(spark, X), "k", TRACKED, EPOCH, names)
    out = scd2_apply(dim, as_versions(snap(spark, Y), "k", TRACKED, T1, names), "k", T1, names)
    assert out.columns == ["k", "a", "b", "name", "h", "since", "until", "live"]
    assert rows(out.select("a", "live")) == [("x", False), ("y", True)]
    assert scd2_as_of(out, "2000-01-01", names).count() == 1


def test_duplicate_customers_take_the_lowest_portfolio_and_nulls_last(spark):
    raw = spark.createDataFrame(
        [("1", p, "P", "1", "M", "br", "Gold") for p in ("7", None, "3", None)]
        + [(None, "1", "P", "1", "M", "br", "Gold")],
        PORTFOLIOS.raw_schema(),
    )
    assert rows(portfolio_snapshot(raw)) == [(1, 3, "P", 1, "M", "BR", "gold")]


def test_known_digests(spark):
    raw = spark.createDataFrame(
        [("101", "1", "Portfolio 1", "1", "Manager 1", "br", "Platinum")], PORTFOLIOS.raw_schema()
    )
    got = portfolio_versions(raw).first()
    assert got["scd_hash"] == "aeb1c829a6adc6529625bfaa4d2fc2d8"
    assert got["portfolio_version_key"] == "d8598b505c7e9e5e35a119b4f0261c73"


def test_injected_overlap_and_flag_are_found(spark):
    dim = history(spark, [X], (T1, [Y]))
    late = F.col("valid_to") + F.expr("interval 40 days")
    assert overlap_failures(dim.withColumn("valid_to", late), "k").count() == 1
    unclosed = dim.withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
    assert overlap_failures(unclosed, "k").count() == 1
    assert current_flag_failures(unclosed).count() == 1
    assert current_flag_failures(dim).count() == 0
    assert unique_failures(dim.unionByName(dim), "k", "is_current").count() == 1


def test_overlap_inside_one_month(spark):
    data = [
        (1, datetime(2020, 1, 1), datetime(2020, 1, 9)),
        (1, datetime(2020, 1, 5), datetime(2020, 1, 20)),
        (1, datetime(2020, 1, 20), None),
        (2, datetime(2020, 1, 1), None),
    ]
    dim = spark.createDataFrame(data, "k long, valid_from timestamp_ntz, valid_to timestamp_ntz")
    assert [r["valid_from"].day for r in overlap_failures(dim, "k").collect()] == [1]


def test_growth_is_changed_plus_new_keys(spark):
    before = snap(spark, X, (2, "x", "p", "n"))
    after = snap(spark, Y, (2, "x", "p", "n"), (3, "x", "p", "n"))
    old = scd2_initial(before, "k", TRACKED)
    new = scd2_apply(old, as_versions(after, "k", TRACKED, T1), "k", T1)
    assert rows(version_growth(before, after, old, new, "k", TRACKED)) == [(2, 1, 1, True)]
    assert changed_keys(before, after, "k", TRACKED).count() == 1


# -- point in time -------------------------------------------------------
METHODS = ("range", "salted", "slots")


def facts(spark, *data):
    return spark.createDataFrame(list(data), "id int, k long, at timestamp_ntz")


def joined(f, dim, how="inner", slots=("month",)):
    carry = ["a", "valid_from"]
    got = {m: rows(point_in_time_join(f, dim, "k", "at", carry, how, m)) for m in METHODS}
    assert got["range"] == got["salted"] == got["slots"]
    for slot in slots:
        assert rows(point_in_time_join(f, dim, "k", "at", carry, how, "slots", slot)) == got["range"]
    return got["range"]


def test_fact_on_the_instant_of_a_change_is_new(spark):
    dim = history(spark, [X], (T1, [Y]))
    f = facts(
        spark,
        (1, 1, datetime(2020, 1, 1, 11, 59)),
        (2, 1, datetime(2020, 1, 1, 12)),
        (3, 1, datetime(1850, 1, 1)),
        (4, 9, datetime(2020, 1, 1)),
        (5, 1, None),
        (6, None, datetime(2020, 1, 1)),
    )
    every = ("year", "month", "week", "day")
    assert [(r[0], r[3]) for r in joined(f, dim, slots=every)] == [(1, "x"), (2, "y")]
    left = joined(f, dim, "left")
    assert [(r[0], r[3]) for r in left] == [
        (1, "x"),
        (2, "y"),
        (3, None),
        (4, None),
        (5, None),
        (6, None),
    ]


def test_date_facts_compare_at_midnight(spark):
    dim = history(spark, [X], (T1, [Y]))
    f = spark.createDataFrame([(1, 1, date(2020, 1, 1)), (2, 1, date(2020, 1, 2))], "id int, k long, at date")
    assert [r["a"] for r in point_in_time_join(f, dim, "k", "at", ["a"]).orderBy("id").collect()] == ["x", "y"]


def test_no_facts(spark):
    dim = history(spark, [X], (T1, [Y]))
    assert joined(facts(spark), dim) == []


def test_name_clash_is_refused(spark):
    dim = history(spark, [X])
    with pytest.raises(ValueError, match="both sides"):
        point_in_time_join(facts(spark).withColumnRenamed("id", "a"), dim, "k", "at")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.dictionaries(st.integers(0, 4), st.sampled_from("xyz"), max_size=5), min_size=1, max_size=3
    ),
    st.lists(st.tuples(st.integers(0, 5), st.integers(0, 100)), max_size=15),
)
def test_methods_agree_with_a_plain_search(spark, snaps, when):
    times = (T1, T2, T3)
    later = [(times[i], [(k, a, "p", "n") for k, a in s.items()]) for i, s in enumerate(snaps)]
    dim = history(spark, [(k, "x", "p", "n") for k in range(3)], *later)
    start = datetime(2019, 12, 15)
    data = [(i, k, start.replace(hour=12) + (T_DAY * d)) for i, (k, d) in enumerate(when)]
    versions = dim.collect()
    assert overlap_failures(dim, "k").count() == 0
    want = [
        (i, k, at, v["a"], v["valid_from"])
        for i, k, at in data
        for v in versions
        if v["k"] == k and v["valid_from"] <= at and (v["valid_to"] is None or at < v["valid_to"])
    ]
    assert joined(facts(spark, *data), dim) == sorted(want, key=repr)


T_DAY = datetime(2020, 1, 2) - datetime(2020, 1, 1)


def test_shift_is_the_difference_of_the_two_joins(spark):
    dim = history(spark, [X, (2, "x", "p", "n")], (T1, [Y, (2, "x", "p", "n")]))
    f = facts(spark, (1, 1, datetime(2019, 1, 1)), (2, 1, datetime(2021, 1, 1)), (3, 2, datetime(2019, 1, 1)))
    shift = attribution_shift(f, dim, "k", "at", ["a"])
    assert [(r["id"], r["then_a"], r["now_a"]) for r in shift.collect()] == [(1, "x", "y")]
    assert rows(current_join(f, dim, "k", ["a"]).select("id", "a")) == [(1, "y"), (2, "y"), (3, "x")]


# -- plans ---------------------------------------------------------------
def hot_facts(spark, n=60_000):
    """A third of the facts on one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000)
    at = F.lit("2020-01-01").cast("timestamp_ntz")
    return spark.range(n).select(F.col("id").cast("int"), key.alias("k"), at.alias("at"))


def many_versions(spark):
    k = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("a"))
    return k.withColumns(
        {
            "valid_from": F.lit(EPOCH).cast("timestamp_ntz"),
            "valid_to": F.lit(None).cast("timestamp_ntz"),
            "is_current": F.lit(True),
        }
    )


def test_spark_splits_the_hot_partition(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.2")
    conf("spark.sql.shuffle.partitions", "16")
    joined = point_in_time_join(hot_facts(spark), many_versions(spark), "k", "at", ["a"])
    assert "skew=true" in final_plan(joined).lower().replace("isskew", "skew").replace(" ", "")
    assert joined.count() == 60_000


def test_salting_takes_over_where_spark_does_not_split(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.enabled", "false")
    joined = point_in_time_join(hot_facts(spark), many_versions(spark), "k", "at", ["a"])
    assert "_salt" in plan_of(joined)
    assert joined.count() == 60_000 and joined.select("id").distinct().count() == 60_000


def test_salting_spreads_only_the_hot_key(spark):
    from strata.operators.skew import hot_keys

    assert [r["k"] for r in hot_keys(hot_facts(spark), ["k"], share=0.1).collect()] == [1]


def test_step_reads_only_open_versions(spark, tmp_path):
    from strata.operators.history import scd2_step
    from strata.sources.tables import Lakehouse

    dim = Lakehouse(spark, str(tmp_path)).history("silver.dim")
    dim.overwrite(history(spark, [X], (T1, [Y])))
    read = dim.open_versions()
    step = scd2_step(read, as_versions(snap(spark, X), "k", TRACKED, T2), "k", T2)
    files = [f for f in step.inputFiles() if f.endswith(".parquet")]
    assert files and all("/is_current=true/" in f for f in files)
    assert any("/is_current=false/" in f for f in dim.read().inputFiles())
