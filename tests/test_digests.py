"""Differences found by digests of key ranges against the full comparison."""

import random
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from support import final_plan, rows, same

from strata.operators.changes import diff_snapshots
from strata.operators.digests import (
    RangedSnapshot,
    coarse_digests,
    diff_by_digests,
    diff_stored,
    differing_ranges,
    range_digests,
)

SNAP = "k long, a string, b string, note string"


def snapshot(spark, data):
    return spark.createDataFrame(data, SNAP)


def changed(rng, n, share):
    before = [(k, rng.choice("xy"), rng.choice(["p", None]), "n") for k in range(n)]
    after = [
        (k, rng.choice(["x", "y", None]), rng.choice(["p", None]), "m") if rng.random() < share else (k, a, b, "other note")
        for k, a, b, _ in before
        if rng.random() > share / 4
    ]
    return before, after + [(n + k, "new", None, "n") for k in range(int(n * share))]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), share=st.sampled_from([0.0, 0.02, 0.5]))
def test_equals_the_full_difference(spark, seed, share):
    before, after = (snapshot(spark, d) for d in changed(random.Random(seed), 120, share))
    same(diff_by_digests(before, after, "k", ["a", "b"]), diff_snapshots(before, after, "k", ["a", "b"]))
    same(diff_by_digests(before, after, "k"), diff_snapshots(before, after, "k"))


def test_a_value_that_changes_places_with_a_null_is_a_change(spark):
    before, after = snapshot(spark, [(1, "x", None, "n")]), snapshot(spark, [(1, None, "x", "n")])
    assert diff_by_digests(before, after, "k").count() == 1


def test_empty_sides(spark):
    some, none = snapshot(spark, [(1, "x", None, "n")]), snapshot(spark, [(1, "x", None, "n")]).limit(0)
    for a, b in ((some, none), (none, some), (none, none)):
        same(diff_by_digests(a, b, "k"), diff_snapshots(a, b, "k"))


def test_coarse_digests_follow_from_fine_ones(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7).alias("v"))
    fine = range_digests(df, "id")
    assert coarse_digests(fine).agg(F.sum("n")).first()[0] == 5000
    other = df.withColumn("v", F.when(F.col("id") == 77, 99).otherwise(F.col("v")))
    assert differing_ranges(fine, range_digests(other, "id")).count() == 1
    assert differing_ranges(fine, range_digests(df.repartition(9), "id")).count() == 0


def test_only_rows_of_differing_ranges_are_compared(spark):
    df = spark.range(20_000).select("id", F.lit("a").alias("v"))
    other = df.withColumn("v", F.when(F.col("id").isin(5, 6), "b").otherwise(F.col("v")))
    got = diff_by_digests(df, other, "id")
    assert rows(got.select("id", "v")) == [(5, "b"), (6, "b")]
    ranges = differing_ranges(range_digests(df, "id"), range_digests(other, "id"))
    assert ranges.count() <= 2
    plan = final_plan(got)
    assert "LeftSemi" in plan


def test_stored_snapshots_are_read_where_they_differ(spark, tmp_path):
    df = spark.range(3000).select("id", F.lit("a").alias("v"))
    for share in (1, 300):
        one, two = (RangedSnapshot(spark, str(tmp_path / f"{share}-{n}"), "id") for n in "12")
        one.write(df)
        two.write(df.withColumn("v", F.when(F.col("id") < share, "b").otherwise(F.col("v"))))
        found = diff_stored(one, two)
        assert found.count() == share
        plan = final_plan(found)
        wanted = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "_coarse" in wanted
        coarse = {r["coarse"] for r in differing_ranges(one.digests(), two.digests()).collect()}
        read = one.read(sorted(coarse)).count()
        assert share <= read <= 3000 and len(coarse) <= share and (share > 1 or read < 60)
    assert len(list(Path(one.path).rglob("_coarse=*"))) == 256


def test_keys_of_two_types_are_refused(spark):
    with pytest.raises(ValueError):
        diff_by_digests(spark.range(1), spark.range(1).select(F.col("id").cast("int")), "id")
