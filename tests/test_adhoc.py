import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from support import rows

from strata.plans import adhoc
from strata.sources.tables import Lakehouse


@pytest.mark.parametrize(
    "sql",
    [
        "select 1",
        "SELECT 1;",
        "  -- note; with a mark\nselect 1 ; -- done",
        "/* drop table t */ with a as (select 1 as x) select x from a",
        "select ';' as x",
        "select 'it''s; -- fine' as x",
        "select `a;b` from (select 1 as `a;b`)",
        "(select 1)",
    ],
)
def test_accepted(spark, sql):
    assert adhoc.query(spark, sql).count() == 1


@pytest.mark.parametrize(
    "sql",
    [
        "",
        " -- nothing\n",
        "drop table t",
        "delete from t",
        "insert into t select 1",
        "update t set a = 1",
        "create table t as select 1",
        "select 1; drop table t",
        "select 1; select 2",
        "set x = 1",
        "/* select */ drop table t",
        "select reflect('java.lang.System', 'exit', 0)",
        "select `reflect`('java.lang.System', 'exit', 0)",
        "select java_method /* x */ ('java.lang.System', 'exit', 0)",
        "select transform(a) using 'cat' as (b) from t",
        "select transform(a) using r'cat' as (b) from t",
        "select identifier('ref' || 'lect')('java.lang.System', 'exit', 0)",
        r"select r'\' as a, reflect('java.lang.System', 'nanoTime') as h, '' as b",
    ],
)
def test_refused(sql):
    with pytest.raises(adhoc.NotReadOnly):
        adhoc.check_read_only(sql)


def test_columns_of_texts_are_judged_alike(spark):
    rng = random.Random(1)
    pieces = ["select", "with", "drop", " ", "\n", ";", "--", "/*", "*/", "'", '"', "`", "\\", "r'", 'R"', "reflect(", "reflect"]
    pieces += ["(", "java_method (", "identifier(", "using ", "using''", "a", "1", ",", "x;y", "''", "é", "\u0001"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(1, 14))) for _ in range(3000)]
    texts += [f"select {t}" for t in texts] + ["select 1", "select 'it''s; -- fine' as x", r"select r'\' as a, reflect('x') as b, ''"]

    def accepted(text):
        try:
            adhoc.check_read_only(text)
        except adhoc.NotReadOnly:
            return False
        return True

    judged = spark.createDataFrame([(t,) for t in texts], "t string").select("t", adhoc.verdicts("t")).collect()
    assert [t for t, verdict in judged if verdict != accepted(t)] == [] and sum(v for _, v in judged) > 1000
    assert spark.sql("select cast(null as string) as t").select(adhoc.verdicts("t")).first()[0] is False


def test_statement_behind_with_cannot_write(spark):
    spark.sql("create or replace temp view src as select 1 as id")
    spark.range(1).write.mode("overwrite").saveAsTable("guard_target")
    try:
        with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
            adhoc.query(spark, "with a as (select 5L as id) insert into guard_target select * from a")
        assert spark.table("guard_target").count() == 1
    finally:
        spark.sql("drop table guard_target")


@pytest.fixture
def service(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    table = lake.table("gold.revenue")
    table.overwrite(spark.createDataFrame([("BR", 1), ("BR", 2), ("US", 3)], "region string, n int"))
    return adhoc.JobLog(spark, str(tmp_path / "jobs")), str(tmp_path / "results"), [table]


def run(spark, service, sql):
    log, results, tables = service
    job = adhoc.submit(log, sql)
    return job, adhoc.run_job(spark, log, job, results, tables)


def test_job_that_succeeds(spark, service):
    log, results, _ = service
    job, state = run(spark, service, "select region, count(*) n from revenue group by 1;")
    assert state == "succeeded"
    assert rows(adhoc.read_result(spark, results, job)) == [("BR", 2), ("US", 1)]
    seen = log.runs().first()
    assert (seen["status"], seen["row_count"], seen["error"]) == ("succeeded", 2, None)
    assert seen["submitted_at"] <= seen["started_at"] <= seen["finished_at"]
    record = json.loads(log.status(job).first()["record"])
    assert record["status"] == "succeeded" and record["result_key"] == f"{job}/result.parquet"
    parsed = spark.createDataFrame([(json.dumps(record),)], "r string").select(
        F.from_json("r", adhoc.LOG_SCHEMA)["row_count"]
    )
    assert parsed.first()[0] == 2


@pytest.mark.parametrize(
    "sql,error",
    [
        ("select * from gold.missing", "TABLE_OR_VIEW_NOT_FOUND"),
        ("select 1 as a, 2 as a", "names of their own"),
        ("select * from parquet.`/etc`", "(?i)parquet|not"),
    ],
)
def test_job_that_fails_is_recorded(spark, service, sql, error):
    import re

    log = service[0]
    job, state = run(spark, service, sql)
    assert state == "failed"
    seen = log.runs().first()
    assert seen["status"] == "failed" and re.search(error, seen["error"])
    assert seen["row_count"] is None and seen["result_key"] is None


def test_refused_text_gets_no_job(spark, service):
    with pytest.raises(adhoc.NotReadOnly):
        adhoc.submit(service[0], "drop table gold.revenue")


def test_unknown_and_malformed_job_ids(spark, service):
    run(spark, service, "select 1 as a")
    assert service[0].status("0" * 32).count() == 0
    for bad in ("", "../x", "A" * 32, "0" * 31):
        with pytest.raises(ValueError):
            service[0].status(bad)


def test_recent_jobs_are_the_newest_first(spark):
    runs = spark.createDataFrame(
        [(f"j{i:02d}", datetime(2026, 1, 1 + i)) for i in range(25)], "job_id string, submitted_at timestamp"
    )
    got = [r["job_id"] for r in adhoc.recent_runs(runs).collect()]
    assert got == [f"j{i:02d}" for i in range(24, 4, -1)]


def test_preview_cuts_and_turns_values_into_text(spark):
    df = spark.range(600).select(
        "id", F.lit("1.50").cast("decimal(18,2)").alias("d"), F.lit("2026-01-01").cast("date").alias("t")
    )
    shown = adhoc.preview(df)
    assert shown.count() == 500
    assert dict(shown.dtypes) == {"id": "bigint", "d": "string", "t": "string"}
    assert shown.first()["d"] == "1.50"


def test_by_name(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "name string")
    assert [r[0] for r in adhoc.by_name(df).collect()] == ["a", "b", None]
