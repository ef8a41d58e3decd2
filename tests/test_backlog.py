"""Several snapshots in one pass against one after the other, and the sweep join against the range join."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from support import final_plan, rows, same

from strata.operators import attribution
from strata.operators.attribution import point_in_time_join
from strata.operators.history import as_versions, scd2_backlog, scd2_initial, scd2_step

SNAP = "k long, a string, b string, name string"
TRACKED = ["a", "b"]
TIMES = [f"2020-0{m}-01 12:00:00" for m in range(1, 8)]


def snapshot(spark, data):
    return spark.createDataFrame(data, SNAP)


def both(spark, first, later):
    """The open versions after the first load and each later snapshot, in single rounds and in one pass."""
    start = scd2_initial(snapshot(spark, first), "k", TRACKED)
    versions = [(as_versions(snapshot(spark, data), "k", TRACKED, at), at) for data, at in zip(later, TIMES)]
    closed, present = start.limit(0), start
    for v, at in versions:
        step = scd2_step(present, v, "k", at)
        closed, present = closed.union(step.filter("not is_current")), step.filter("is_current")
    return closed.union(present), scd2_backlog(start, versions, "k")


def test_every_fate_of_a_key(spark):
    x, y, z = (("x", "p"), ("y", "p"), ("z", None))
    fates = {
        1: [x, x, x, x, x],  # stays
        2: [x, y, y, x, x],  # changes and changes back
        3: [x, None, x, None, x],  # leaves and returns, twice
        4: [None, None, x, x, None],  # arrives late, leaves
        5: [x, None, None, None, None],  # leaves for good
        6: [None, None, None, None, y],  # arrives last
        7: [z, z, x, z, z],  # nulls compare as values
    }
    data = [[(k, *f[n], f"n{n}") for k, f in fates.items() if f[n]] for n in range(5)]
    single, once = both(spark, data[0], data[1:])
    same(once, single)
    assert once.filter("k = 3").count() == 3
    # Untracked columns stay as they were when the version began.
    assert rows(once.filter("k = 1").select("name", "is_current")) == [("n0", True)]


def test_empty_snapshots_close_everything(spark):
    x = (1, "x", "p", "n")
    for later in ([[]], [[x], []], [[], [x]], [[], []]):
        single, once = both(spark, [x, (2, "y", "q", "n")], later)
        same(once, single)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000))
def test_as_many_rounds_as_wait(spark, seed):
    rng = random.Random(seed)
    data = [
        [(k, rng.choice("xy"), rng.choice(["p", None]), f"n{n}") for k in range(12) if rng.random() < 0.7]
        for n in range(rng.randrange(2, 6))
    ]
    single, once = both(spark, data[0], data[1:])
    same(once, single)


def test_one_shuffle_however_many_wait(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    x = (1, "x", "p", "n")
    start = scd2_initial(snapshot(spark, [x]), "k", TRACKED)
    waiting = [(as_versions(snapshot(spark, [x]), "k", TRACKED, at), at) for at in TIMES]
    assert final_plan(scd2_backlog(start, waiting, "k")).split("Initial Plan")[0].count("Exchange ") == 1
    same(scd2_backlog(start, [], "k"), start)


# -- the sweep -----------------------------------------------------------
@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)
    start = datetime(2020, 1, 1)
    versions = []
    for k in range(20):
        at = start
        for n in range(rng.choice([1, 2, 40])):
            end = at + timedelta(hours=rng.randrange(0, 200))
            versions.append((k, at, end if rng.random() < 0.95 else at, f"v{k}-{n}"))  # some cover nothing
            at = end + timedelta(hours=rng.choice([0, 0, 0, 5]))
        if k % 2:
            versions.append((k, at, None, f"open{k}"))
    versions += [(None, start, None, "no key"), (3, None, None, "no start")]
    facts = [
        (n, 0 if n % 3 == 0 else rng.choice([None, *range(22)]), start + timedelta(hours=rng.randrange(-50, 3000)))
        for n in range(1500)
    ]
    facts += [(n, v[0], v[1]) for n, v in enumerate(versions, 5000)]  # on the instant of a start
    facts += [(9999, 1, None)]
    return (
        spark.createDataFrame(facts, "id int, k int, ts timestamp_ntz"),
        spark.createDataFrame(versions, "k int, valid_from timestamp_ntz, valid_to timestamp_ntz, name string"),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [False, True])
def test_sweep_equals_range(spark, sides, monkeypatch, how, hot):
    facts, versions = sides
    if hot:
        monkeypatch.setattr(attribution, "SLICE_FACTS", 60)
        monkeypatch.setattr(attribution, "SAMPLE", 1)
    swept = point_in_time_join(facts, versions, "k", "ts", ["name"], how, "sweep")
    same(swept, point_in_time_join(facts, versions, "k", "ts", ["name"], how, "range"))


def test_a_hot_key_is_many_slices(spark, sides, monkeypatch):
    facts, versions = sides
    monkeypatch.setattr(attribution, "SLICE_FACTS", 50)
    monkeypatch.setattr(attribution, "SAMPLE", 1)
    placed = facts.filter("k is not null and ts is not null").withColumnRenamed("ts", "_at")
    right = versions.selectExpr("k", "valid_from as _at", "struct(name, valid_to) as _version").filter("_at is not null")
    sliced, carried = attribution._sliced(placed, right, "k")
    counts = [r["count"] for r in sliced.filter("k = 0").groupBy("_slice").count().collect()]
    assert len(counts) >= 8 and max(counts) < 0.4 * sum(counts)
    assert sliced.filter("k = 5").select("_slice").distinct().count() < len(counts)
    # One row more per slice at most, not one per version and slice.
    assert carried.filter("k = 0").count() <= right.filter("k = 0").count() + len(counts) + 10


def test_sweep_of_nothing(spark, sides):
    facts, versions = sides
    assert point_in_time_join(facts.limit(0), versions, "k", "ts", ["name"], method="sweep").count() == 0
    left = point_in_time_join(facts, versions.limit(0), "k", "ts", ["name"], "left", "sweep")
    assert left.count() == facts.count() and left.filter("name is not null").count() == 0
    with pytest.raises(ValueError):
        point_in_time_join(facts, versions, "k", "ts", ["name"], "outer", "sweep")
