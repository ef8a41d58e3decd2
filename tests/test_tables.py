import pytest
from pyspark.sql import functions as F
from support import plan_of, rows, same

from strata.operators.changes import merge_changes
from strata.operators.history import as_versions, scd2_initial, scd2_step
from strata.sources.tables import Files, Lakehouse


@pytest.fixture
def lake(spark, tmp_path):
    return Lakehouse(spark, str(tmp_path / "lake"))


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_versions_and_reading_back(spark, lake):
    t = lake.table("silver.t")
    assert not t.exists() and t.version() is None and t.last_batch() is None
    with pytest.raises(LookupError):
        t.read()
    assert t.overwrite(spark.range(3)) == 0
    assert t.update(lambda now: now.filter("id > 0"), batch=7) == 1  # reads what it replaces
    assert ids(t.read()) == [1, 2] and ids(t.read(0)) == [0, 1, 2]
    assert t.versions() == [0, 1] and t.last_batch() == 7


def test_half_written_version_is_not_seen(spark, lake):
    t = lake.table("silver.t")
    t.overwrite(spark.range(3))
    spark.range(9).write.parquet(f"{t.path}/data/v=1")  # a writer that died before its commit
    assert ids(t.read()) == [0, 1, 2]
    assert t.overwrite(spark.range(5)) == 1
    assert ids(t.read()) == [0, 1, 2, 3, 4]


def test_second_writer_of_a_version_loses(spark, lake):
    t = lake.table("silver.t")
    t.overwrite(spark.range(1))
    with pytest.raises(Exception, match="already exists"):
        t._publish(spark.range(2), 0)


def test_vacuum_keeps_the_last(spark, lake):
    t = lake.table("silver.t")
    for n in range(4):
        t.overwrite(spark.range(n + 1))
    assert t.vacuum(keep=2) == [0, 1]
    assert t.versions() == [2, 3] and ids(t.read(2)) == [0, 1, 2]
    with pytest.raises(ValueError):
        t.vacuum(0)


def test_empty_table_keeps_its_schema(spark, lake):
    t = lake.table("silver.t")
    t.overwrite(spark.range(0).withColumn("d", F.lit(1).cast("decimal(18,2)")))
    assert t.read().schema.simpleString() == "struct<id:bigint,d:decimal(18,2)>"


def test_names_resolve_with_and_without_namespace(spark, lake):
    t = lake.table("silver.named")
    t.overwrite(spark.range(3))
    t.register()
    assert spark.sql("select count(*) from silver.named a join named b using (id)").first()[0] == 3
    t.overwrite(spark.range(5))
    t.register()  # again, after a new version
    assert spark.table("silver.named").count() == 5 and spark.table("named").count() == 5


SNAP = "id long, a string"


def versions(spark, data, at=None):
    df = spark.createDataFrame(data, SNAP)
    return scd2_initial(df, "id", ["a"]) if at is None else as_versions(df, "id", ["a"], at)


def test_history_rounds(spark, lake):
    dim = lake.history("silver.dim")
    dim.overwrite(versions(spark, [(1, "x"), (2, "x")]))
    t1, t2 = "2020-01-01 00:00:00", "2021-01-01 00:00:00"
    dim.advance(lambda o: scd2_step(o, versions(spark, [(1, "y"), (2, "x")], t1), "id", t1))
    dim.advance(lambda o: scd2_step(o, versions(spark, [(1, "z")], t2), "id", t2), batch=4)
    assert rows(dim.read().select("id", "a", "is_current")) == [
        (1, "x", False),
        (1, "y", False),
        (1, "z", True),
        (2, "x", False),
    ]
    assert dim.last_batch() == 4
    assert dim.read(1).count() == 3 and dim.read(0).count() == 2
    assert dim.read().columns == versions(spark, [], t1).columns
    assert dim.closed_versions().count() == 3 and dim.open_versions().count() == 1
    names = [f"v={n}" for n in range(3)]
    assert sorted(Files(spark, dim.path).names(f"{dim.path}/data")) == names
    dim.register()
    same(spark.table("silver.dim"), dim.read())
    same(spark.table("dim"), dim.read())
    before = rows(dim.read())
    assert dim.vacuum(keep=1) == [0, 1]
    assert rows(dim.read()) == before  # closed versions of old rounds are still there


def test_history_full_write_starts_over(spark, lake):
    dim = lake.history("silver.dim")
    dim.overwrite(versions(spark, [(1, "x")]))
    t1 = "2020-01-01 00:00:00"
    dim.advance(lambda o: scd2_step(o, versions(spark, [], t1), "id", t1))
    dim.overwrite(versions(spark, [(5, "x")]))
    assert rows(dim.read().select("id", "is_current")) == [(5, True)]
    assert dim.vacuum(keep=2) == [0]  # version 1 still needs what round 0 and 1 closed
    assert rows(dim.read(1).select("id", "is_current")) == [(1, False)]
    assert dim.vacuum(keep=1) == [1]
    # Round 0 was only thinned out before; the full write made all of round 1 obsolete.
    assert "v=1" not in Files(spark, dim.path).names(f"{dim.path}/data")
    assert rows(dim.read().select("id", "is_current")) == [(5, True)]


def test_compaction_is_a_full_write_of_itself(spark, lake):
    dim = lake.history("silver.dim")
    dim.overwrite(versions(spark, [(1, "x"), (2, "x")]))
    t1 = "2020-01-01 00:00:00"
    dim.advance(lambda o: scd2_step(o, versions(spark, [(1, "y")], t1), "id", t1))
    before = rows(dim.read())
    dim.overwrite(dim.read())
    dim.vacuum()
    assert rows(dim.read()) == before


def test_bucketed_table_is_merged_without_a_shuffle(spark, lake, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    t = lake.table("silver.bucketed", bucket_by=("id", 4))
    t.overwrite(spark.range(1000).withColumn("v", F.lit("a")))
    batch = spark.createDataFrame([(1, "b", "U"), (2, "a", "D")], "id long, v string, _cdc_op string")
    merged = merge_changes(t.read(), batch, "id")
    assert plan_of(merged).count("Exchange hashpartitioning") == 1  # the batch only
    t.update(lambda now: merge_changes(now, batch, "id"))
    assert t.read().count() == 999
    files = [n for n in Files(spark, t.path).names(t._folder(1, t.commit()["writer"])) if n.startswith("part-")]
    assert len(files) == 4  # one per bucket, without another shuffle
    again = Lakehouse(spark, lake.root).table("silver.bucketed", bucket_by=("id", 4))
    assert again.read().filter("v = 'b'").count() == 1
    t.register()
    assert spark.table("silver.bucketed").count() == 999
