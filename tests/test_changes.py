import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from support import plan_of, rows, same

from strata.operators.changes import (
    check_batch,
    diff_snapshots,
    exclusive_split,
    merge_changes,
)
from strata.operators.keyed import insert_unique, patch_rows

TARGET = "k long, v string, loaded string"
BATCH = TARGET + ", _cdc_op string, seq int"


def target(spark, *data):
    return spark.createDataFrame(list(data), TARGET)


def batch(spark, *data):
    return spark.createDataFrame(list(data), BATCH)


def merged(t, b, **kw):
    kw.setdefault("preserve", ["loaded"])
    kw.setdefault("order_by", ["seq"])
    out = {s: merge_changes(t, b, "k", strategy=s, **kw) for s in ("lookup", "outer")}
    same(out["lookup"], out["outer"])
    return rows(out["outer"])


def test_delete_and_update_in_one_batch_gives_a_fresh_row(spark):
    t = target(spark, (1, "a", "old"), (2, "b", "old"))
    b = batch(spark, (1, None, "new", "D", 2), (1, "z", "new", "U", 1))
    assert merged(t, b) == [(1, "z", "new"), (2, "b", "old")]


def test_last_of_two_updates_wins(spark):
    t = target(spark, (1, "a", "old"))
    b = batch(spark, (1, "second", "n2", "U", 2), (1, "first", "n1", "U", 1))
    assert merged(t, b) == [(1, "second", "old")]


def test_two_updates_can_be_an_error(spark):
    t = target(spark, (1, "a", "old"))
    b = batch(spark, (1, "x", "n", "U", 1), (1, "y", "n", "U", 2))
    for strategy in ("lookup", "outer"):
        with pytest.raises(Exception, match="several rows to apply for k 1"):
            merge_changes(t, b, "k", on_duplicate="error", strategy=strategy).collect()


def test_unknown_keys_and_codes(spark):
    t = target(spark, (1, "a", "old"), (2, "b", "old"), (3, "c", "old"), (4, "d", "old"))
    b = batch(
        spark,
        (9, "u", "new", "U", 1),  # update of a missing key inserts
        (1, "i", "new", "I", 1),  # insert of a known key updates
        (8, None, "new", "D", 1),  # delete of a missing key does nothing
        (2, "n", "new", None, 1),  # no code: not applied
        (3, "?", "new", "X", 1),  # unknown code counts as an upsert
        (4, "e", "new", "", 1),  # so does an empty one
    )
    assert merged(t, b) == [
        (1, "i", "old"),
        (2, "b", "old"),
        (3, "?", "old"),
        (4, "e", "old"),
        (9, "u", "new"),
    ]


def test_update_to_null_overwrites(spark):
    t = target(spark, (1, "a", "old"))
    assert merged(t, batch(spark, (1, None, "new", "U", 1))) == [(1, None, "old")]


def test_all_columns_follow_without_preserve(spark):
    t = target(spark, (1, "a", "old"))
    b = batch(spark, (1, "b", "new", "U", 1))
    assert merged(t, b, preserve=[]) == [(1, "b", "new")]


def test_missing_column_is_refused(spark):
    with pytest.raises(ValueError, match="lacks columns"):
        merge_changes(target(spark, (1, "a", "x")), batch(spark).drop("v"), "k")


def test_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    # Stored inputs, so that Spark knows their sizes.
    path, changes = str(tmp_path / "t"), str(tmp_path / "b")
    spark.range(10_000).select(
        F.col("id").alias("k"), F.lit("a").alias("v"), F.lit("o").alias("loaded")
    ).write.parquet(path)
    batch(spark, (1, "b", "n", "U", 1)).write.parquet(changes)
    t, b = spark.read.parquet(path), spark.read.parquet(changes)
    plan = plan_of(merge_changes(t, b, "k", order_by=["seq"]))
    assert "SortMergeJoin" not in plan and "FullOuter" not in plan
    # The only shuffles are those that reduce the batch.
    assert plan.count("Exchange hashpartitioning") == plan.count("partial_max_by")


def test_one_key_with_a_third_of_the_batch(spark):
    seq = F.col("id").cast("int")
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long")
    b = spark.range(30_000).select(
        key.alias("k"),
        F.col("id").cast("string").alias("v"),
        F.lit("new").alias("loaded"),
        F.lit("U").alias("_cdc_op"),
        seq.alias("seq"),
    )
    t = target(spark, (7, "a", "old"))
    for strategy in ("lookup", "outer"):
        out = merge_changes(t, b, "k", ["loaded"], ["seq"], strategy=strategy)
        plan = plan_of(out)
        assert plan.index("Exchange hashpartitioning") < plan.index("partial_max_by")
        assert out.count() == 20_000  # keys 1, 2, 4, 5, ... with 7 among them
        assert rows(out.filter("k = 7")) == [(7, "29997", "old")]


def test_large_batch_takes_the_outer_join(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    t = target(spark, (1, "a", "old"))
    assert "FullOuter" in plan_of(merge_changes(t, batch(spark, (1, "b", "n", "U", 1)), "k"))


def test_check_batch(spark):
    b = batch(
        spark,
        (1, "a", "n", "D", 1),
        (1, "a", "n", "U", 2),
        (2, "a", "n", "U", 1),
        (2, "a", "n", "I", 2),
        (3, "a", "n", "U", 1),
        (4, "a", "n", "D", 1),
    )
    assert rows(check_batch(b, "k")) == [(1, 1, 1, True, False), (2, 0, 2, False, True)]


def test_split_has_no_overlap_and_repeats(spark):
    df = spark.range(5000)
    shares = {"D": 500, "U": 2000}
    first = exclusive_split(df, "id", shares)
    same(first, exclusive_split(df.repartition(7), "id", shares))
    found = dict(rows(first.groupBy("split").count()))
    assert found["D"] + found["U"] + found[None] == 5000
    assert 150 < found["D"] < 350 and 800 < found["U"] < 1200


OPS_FIELDS = (
    st.integers(0, 8),
    st.sampled_from(["a", "b", None]),
    st.sampled_from(["I", "U", "D", "X", None]),
)
OPS = st.lists(st.tuples(*OPS_FIELDS), max_size=12)
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@FEW
@given(st.dictionaries(st.integers(0, 8), st.sampled_from(["p", None]), max_size=8), OPS)
def test_merge_against_a_plain_replay(spark, before, ops):
    t = target(spark, *[(k, v, "old") for k, v in before.items()])
    b = batch(spark, *[(k, v, "new", op, i) for i, (k, v, op) in enumerate(ops)])
    want = {k: (k, v, "old") for k, v in before.items()}
    for k, _, op in ops:
        if op == "D":
            want.pop(k, None)
    for k, v, op in ops:
        if op not in ("D", None):
            want[k] = (k, v, want[k][2] if k in want else "new")
    assert merged(t, b) == sorted(want.values(), key=repr)


SERIES = st.lists(st.tuples(st.integers(0, 3), *OPS_FIELDS), max_size=14)


@FEW
@given(st.dictionaries(st.integers(0, 4), st.just("p"), max_size=4), SERIES)
def test_batches_in_sequence_equal_one_after_the_other(spark, before, ops):
    t = target(spark, *[(k, v, "old") for k, v in before.items()])
    data = [(k, v, f"n{step}", op, i, step) for i, (step, k, v, op) in enumerate(ops)]
    every = spark.createDataFrame(data, BATCH + ", step int")
    want = rows(t)
    for step in range(4):
        now = spark.createDataFrame(want, TARGET)
        want = merged(now, every.filter(f"step = {step}").drop("step"))
    assert merged(t, every, sequence="step") == want


SNAPSHOT = st.dictionaries(st.integers(0, 9), st.sampled_from(["a", "b", None]), max_size=9)


@FEW
@given(SNAPSHOT, SNAPSHOT)
def test_diff_round_trip(spark, before, after):
    a, b = (spark.createDataFrame(list(d.items()), "k long, v string") for d in (before, after))
    diff = diff_snapshots(a, b, "k")
    same(merge_changes(a, diff, "k"), b)
    assert diff_snapshots(b, b, "k").count() == 0


def test_patch_keeps_what_is_not_given(spark):
    t = spark.createDataFrame([(1, "q", "x", None), (2, "q", "y", 5)], "k long, st string, a string, n int")
    p = spark.createDataFrame(
        [(1, "run", None, 1, 1), (1, "done", None, None, 2), (3, "done", "z", 9, 1)],
        "k long, st string, a string, n int, seq int",
    )
    assert rows(patch_rows(t, p, "k", ["seq"], overwrite=["st"])) == [
        (1, "done", "x", 1),
        (2, "q", "y", 5),
    ]


def test_patch_overwrites_listed_columns_with_null(spark):
    t = spark.createDataFrame([(1, "q")], "k long, st string")
    p = spark.createDataFrame([(1, None, 1)], "k long, st string, seq int")
    assert rows(patch_rows(t, p, "k", ["seq"])) == [(1, "q")]
    assert rows(patch_rows(t, p, "k", ["seq"], overwrite=["st"])) == [(1, None)]


def test_insert_unique_refuses_taken_and_repeated_names(spark):
    t = spark.createDataFrame([("a", 1)], "name string, id int")
    c = spark.createDataFrame([("a", 2), ("b", 4), ("b", 3), ("c", 5)], "name string, id int")
    table, refused = insert_unique(t, c, "name", ["id"])
    assert rows(table) == [("a", 1), ("b", 3), ("c", 5)]
    assert rows(refused) == [("a", 2), ("b", 4)]
