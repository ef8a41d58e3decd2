import pytest
from pyspark.sql import functions as F
from support import plan_of, rows

import strata.operators.quality as q
from strata.operators.dedup import first_per_key
from strata.operators.hierarchy import dense_index, parent_catalog, propagate_parents


def test_nulls_pass_all_but_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (None, None), (None, "z"), (1, "b")], "k int, s string")
    parent = spark.createDataFrame([(2,)], "k int")
    assert rows(q.unique_failures(df, "k")) == [(1, 2)]
    assert rows(q.accepted_failures(df, "s", ["a", "b"])) == [("z", 1)]
    assert rows(q.orphan_failures(df, "k", parent, "k")) == [(1, 2)]
    assert q.not_null_failures(df, "s").count() == 1


def test_population(spark):
    one, two = spark.range(5).toDF("k"), spark.range(5).toDF("k")
    q.assert_population(one, two, "k")
    with pytest.raises(ValueError, match="population"):
        q.assert_population(one, two.unionByName(two), "k")
    with pytest.raises(ValueError, match="population"):
        q.assert_population(one, two.filter("k > 0"), "k")


def test_reconcile_finds_a_lost_row(spark):
    before = spark.range(5)
    changes = spark.createDataFrame([(0, "D"), (9, "I"), (1, "U")], "id long, _cdc_op string")
    good, bad = spark.range(5), spark.range(4)
    assert q.reconcile_counts(before, good, changes).first()["balanced"]
    assert not q.reconcile_counts(before, bad, changes).first()["balanced"]


def test_suite_counts_like_the_single_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (3, "z")], "k int, s string")
    parent = spark.createDataFrame([(3,)], "k int")
    rules = [
        q.Unique("t", "k"),
        q.NotNull("t", "s"),
        q.Accepted("t", "s", ("a",)),
        q.Related("t", "k", "p", "k"),
    ]
    report = q.run_suite({"t": df, "p": parent}, rules)
    assert rows(report.select("rule", "failures")) == [
        ("accepted_values", 1),
        ("not_null", 1),
        ("relationships", 2),
        ("unique", 1),
    ]


def test_orphans_are_counted_before_the_join(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    child = spark.range(1000).select((F.col("id") % 3).alias("fk"))
    plan = plan_of(q.orphan_failures(child, "fk", spark.range(2), "id"))
    join, aggregate = plan.index("LeftAnti"), plan.index("partial_count")
    assert join < aggregate  # the aggregate is below the join


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    first = first_per_key(df, "k", ["v"])
    assert rows(first) == [(0, 0), (1, 1), (2, 2)]
    plan = plan_of(first)
    assert plan.index("Exchange") < plan.index("Partial")


def test_catalog_has_one_row_per_parent_that_disagrees(spark):
    children = spark.createDataFrame(
        [(2, 7, "b"), (1, 7, "a"), (3, 8, "c")], "child int, parent int, attr string"
    )
    assert rows(parent_catalog(children, "parent", ["attr"], "child")) == [(7, "a"), (8, "c")]


@pytest.mark.parametrize("method", ["plain", "salted"])
def test_parent_change_reaches_all_children(spark, method):
    children = spark.range(90).select(
        F.col("id").alias("child"), F.when(F.col("id") < 60, 1).otherwise(2).alias("parent"), F.lit("old").alias("attr")
    )
    parents = spark.createDataFrame([(1, "new"), (2, "old")], "parent int, attr string")
    moved = propagate_parents(children, parents, "parent", ["attr"], method)
    assert moved.columns == children.columns
    assert rows(moved.groupBy("parent", "attr").count()) == [(1, "new", 60), (2, "old", 30)]


def test_dense_index_over_gaps_negatives_and_repeats(spark):
    ids = spark.range(0, 5000, 7).select((F.col("id") - 2000).alias("id")).unionAll(spark.range(10))
    values = sorted({r["id"] for r in ids.collect()})
    got = dense_index(ids, "id").orderBy("idx").collect()
    assert [(r["idx"], r["id"]) for r in got] == list(enumerate(values, 1))


def test_dense_index_of_text(spark):
    got = dense_index(spark.createDataFrame([("b",), ("a",), ("b",)], "s string"), "s")
    assert rows(got) == [(1, "a"), (2, "b")]
