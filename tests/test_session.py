import pytest
from pyspark.sql import functions as F

from strata.operators.skew import fits_broadcast, splits_skew
from strata.session import scratch_dir, settle, shared_dir


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        pytest.skip("no folder named here")
    assert shared_dir(spark) == named.rstrip("/")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_settled_rows_do_not_change(spark):
    df = settle(spark.range(100).withColumn("r", F.rand()))
    assert sorted(df.collect()) == sorted(df.collect())


def test_size_check_follows_the_session(spark, tmp_path, conf):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert fits_broadcast(df)
    conf("spark.sql.autoBroadcastJoinThreshold", "100")
    assert not fits_broadcast(df)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert not fits_broadcast(df)


def test_skew_setting_is_read_from_the_session(spark, conf):
    assert splits_skew(spark)
    conf("spark.sql.adaptive.enabled", "false")
    assert not splits_skew(spark)
