"""Cases where rows were once lost, doubled or wrong."""

import os
from datetime import date
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F
from support import plan_of, rows, write_file

from strata.operators.changes import merge_changes
from strata.operators.conform import conform
from strata.operators.hierarchy import propagate_parents
from strata.operators.quality import overlap_failures
from strata.plans import adhoc
from strata.plans.models import portfolio_versions
from strata.plans.pipeline import build
from strata.schema import CLIENTS, INVENTORY, PORTFOLIOS
from strata.sources.files import land, read_csv, read_full_load, write_csv
from strata.sources.tables import Lakehouse
from strata.streaming.files import apply_change_files, apply_snapshot_files

HEADER = "customer_id,name,email,country,signup_date,segment,_cdc_op"


def line(key, name, op):
    return f"{key},{name},,BR,2020-01-01,vip,{op}"


def clients(spark, tmp_path):
    table = Lakehouse(spark, str(tmp_path / "lake")).table("silver.stg_clients")
    raw = spark.createDataFrame([("1", "n1", None, "br", "2020-01-01", "vip")], CLIENTS.raw_schema())
    table.overwrite(conform(raw, CLIENTS, "2026-01-01 00:00:00"))
    return table


@pytest.mark.parametrize("max_files", [1, 2, 100])
def test_files_count_as_written_however_many_a_batch_holds(spark, tmp_path, max_files):
    table = clients(spark, tmp_path)
    for n, (name, text) in enumerate([("b.csv", line(1, "old", "U")), ("a.csv", line(1, "new", "U")), ("0.csv", line(2, "x", "I"))]):
        write_file(tmp_path / "cdc", name, HEADER, text)
        os.utime(tmp_path / "cdc" / name, (1_700_000_000 + n, 1_700_000_000 + n))
    apply_change_files(
        spark, str(tmp_path / "cdc"), CLIENTS, table, str(tmp_path / "mark"), max_files=max_files
    ).awaitTermination()
    assert dict(rows(table.read().select("customer_id", "name"))) == {1: "new", 2: "x"}


@pytest.mark.parametrize("runs", [1, 2])
def test_build_applies_each_change_file_once(spark, tmp_path, runs):
    bronze = tmp_path / "bronze"
    own = HEADER.rsplit(",", 1)[0]
    write_file(bronze / "clients", "base.csv", own, "1,n1,,BR,2020-01-01,vip")
    write_file(bronze / "orders", "base.csv", "order_id,customer_id,product_id,quantity,order_date,amount,status", "1,1,1,1,2020-01-01,1.00,paid")
    write_file(
        bronze / "inventory",
        "base.csv",
        "product_id,warehouse_id,category,quantity_on_hand,unit_cost,last_restock_date,status",
        "1,1,c,1,1.00,2020-01-01,active",
    )
    write_file(bronze / "portfolios", "p.csv", ",".join(PORTFOLIOS.columns), "1,1,P,1,M,br,gold")
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    build(lake, str(bronze), mode="run")
    steps = [("1.csv", line(9, "in", "I")), ("2.csv", line(9, "", "D"))]
    for n, (name, text) in enumerate(steps):
        write_file(bronze / "clients" / "cdc", name, HEADER, text)
        os.utime(bronze / "clients" / "cdc" / name, (1_700_000_000 + n, 1_700_000_000 + n))
        if runs == 2 or n == 1:
            build(lake, str(bronze), mode="run")
    assert rows(lake.table("silver.stg_clients").read().select("customer_id")) == [(1,)]
    before = lake.table("silver.stg_clients").versions()
    build(lake, str(bronze), mode="run")  # nothing new
    assert lake.table("silver.stg_clients").versions() == before


def test_a_writer_that_loses_harms_nobody(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    winner, loser = lake.table("silver.t"), lake.table("silver.t")
    winner.overwrite(spark.range(1))
    loser._next = lambda: 1  # both found version 0 and write version 1
    winner.overwrite(spark.range(10))
    with pytest.raises(Exception, match="already exists"):
        loser.overwrite(spark.range(77))
    assert winner.read().count() == 10 and winner.versions() == [0, 1]
    winner.register()
    assert spark.table("silver.t").count() == 10


def test_names_stay_while_another_job_registers(spark, tmp_path):
    table = Lakehouse(spark, str(tmp_path / "lake")).table("silver.shared")
    table.overwrite(spark.range(3))
    first = adhoc.read_only_session(spark, [table])
    pending = adhoc.query(first, "select count(*) as n from silver.shared")
    table.overwrite(spark.range(5))
    second = adhoc.read_only_session(spark, [table])
    assert adhoc.query(second, "select count(*) as n from silver.shared").first()["n"] == 5
    assert pending.first()["n"] == 3


@pytest.mark.parametrize(
    "sql",
    [
        r"select r'\' as a, reflect('java.lang.System', 'getProperty', 'user.home') as h, '' as b",
        r"select r'\' as a, (select reflect('java.lang.System', 'getProperty', 'user.home')) as h, '' as b",
        r"""select r"\" as a, java_method('java.lang.System', 'getProperty', 'user.home') as h, "" as b""",
        r"select r'\' as a, try_reflect('java.lang.System', 'getProperty', 'user.home') as h, '' as b",
        r"with t as (select r'\' as a, reflect('java.lang.System', 'nanoTime') as h, '' as b) select a from t",
        r"select 1 where r'\' = '' or exists(select reflect('java.lang.System', 'nanoTime'), '')",
        "select `reflect`('java.lang.System', 'nanoTime')",
        "/* a /* b /* c */ */ drop table t */ select reflect('java.lang.System', 'nanoTime')",
    ],
)
def test_no_spelling_hides_a_call(spark, sql):
    with pytest.raises(adhoc.NotReadOnly):
        adhoc.query(spark, sql)


@pytest.mark.parametrize("sql", ["select 'reflect(' as a", r"select r'\' as a"])
def test_harmless_texts_pass(spark, sql):
    assert adhoc.query(spark, sql).count() == 1


def test_jobs_run_the_text_they_were_submitted_with(spark, tmp_path):
    log = adhoc.JobLog(spark, str(tmp_path / "jobs"))
    one, two = adhoc.submit(log, "select 1 as a"), adhoc.submit(log, "select 2 as a")
    assert [adhoc.run_job(spark, log, j, str(tmp_path / "results")) for j in (two, one)] == ["succeeded"] * 2
    assert adhoc.read_result(spark, str(tmp_path / "results"), one).first()["a"] == 1
    with pytest.raises(LookupError):
        adhoc.run_job(spark, log, "0" * 32, str(tmp_path / "results"))


VALUES = ['Bob "B" Lee', 'a, "b"', "back\\slash", 'end\\"', '""', "plain", "trail "]


def test_csv_is_what_other_tools_write_and_read(spark, tmp_path):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (customer_id VARCHAR, name VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(str(k), v) for k, v in enumerate(VALUES)])
    con.execute(f"COPY t TO '{tmp_path}/in.csv' (HEADER, DELIMITER ',')")
    got = read_csv(spark, str(tmp_path / "in.csv"), "customer_id string, name string")
    assert rows(got) == [(str(k), v) for k, v in enumerate(VALUES)]
    write_csv(got, str(tmp_path / "out"))
    back = con.sql(f"SELECT * FROM read_csv('{tmp_path}/out/*.csv', header=true, all_varchar=true, quote='\"', escape='\"')")
    assert sorted(back.fetchall()) == [(str(k), v) for k, v in enumerate(VALUES)]


def test_line_breaks_inside_quotes_on_request(spark, tmp_path):
    (tmp_path / "in.csv").write_text('customer_id,name\n1,"a\nb"\n')
    got = read_csv(spark, str(tmp_path / "in.csv"), "customer_id string, name string", multi_line=True)
    assert rows(got) == [("1", "a\nb")]


def test_landing_again_replaces(spark, tmp_path):
    own = "product_id,warehouse_id,category,quantity_on_hand,unit_cost,last_restock_date,status"
    write_file(tmp_path / "in", "2024.csv", own, "1,2,Toys,3,4.50,2026-01-01,x")
    for _ in range(2):
        day = land(spark, str(tmp_path / "in"), str(tmp_path / "landed"), INVENTORY, date(2026, 1, 1))
    assert day.count() == 1 and day.first()["_source_file"] == "2024.csv"
    land(spark, str(tmp_path / "in"), str(tmp_path / "landed"), INVENTORY, date(2026, 1, 2))
    assert spark.read.parquet(str(tmp_path / "landed")).count() == 2


def test_snapshot_of_several_files_is_one_round(spark, tmp_path):
    dim = Lakehouse(spark, str(tmp_path / "lake")).history("silver.dim")
    head = ",".join(PORTFOLIOS.columns)
    for n, parts in enumerate([["1,1,P,1,M,br,gold", "2,1,P,1,M,br,gold"], ["1,2,P,1,M,br,gold", "2,1,P,1,M,br,gold"]]):
        for k, text in enumerate(parts):
            write_file(tmp_path / "in" / f"s{n}", f"{k}.csv", head, text)
            os.utime(tmp_path / "in" / f"s{n}" / f"{k}.csv", (1_700_000_000 + n, 1_700_000_000 + n))
    for _ in range(2):
        apply_snapshot_files(
            spark, str(tmp_path / "in"), PORTFOLIOS, dim, str(tmp_path / "mark"), portfolio_versions, by_folder=True
        ).awaitTermination()
    got = rows(dim.read().select("customer_id", "portfolio_id", "is_current"))
    assert got == [(1, 1, False), (1, 2, True), (2, 1, True)]


def test_a_change_without_its_place_is_an_error(spark):
    target = spark.createDataFrame([(1, "a")], "id long, v string")
    batch = spark.createDataFrame([(1, "b", "U", 1), (2, "c", "U", None)], "id long, v string, _cdc_op string, n int")
    with pytest.raises(Exception, match="has no n"):
        merge_changes(target, batch, "id", sequence="n").collect()


def test_children_without_a_parent_keep_their_values(spark):
    children = spark.createDataFrame([(1, 10, "old"), (2, None, "own"), (3, 99, "alone")], "id long, p long, a string")
    parents = spark.createDataFrame([(10, "new"), (20, "x")], "p long, a string")
    assert rows(propagate_parents(children, parents, "p", ["a"])) == [(1, 10, "new"), (2, None, "own"), (3, 99, "alone")]


def test_a_parent_may_give_null(spark):
    children = spark.createDataFrame([(1, 10, "old")], "id long, p long, a string")
    parents = spark.createDataFrame([(10, None)], "p long, a string")
    assert rows(propagate_parents(children, parents, "p", ["a"])) == [(1, 10, None)]


def test_versions_without_a_key_are_checked(spark):
    df = spark.createDataFrame(
        [(None, "2020-01-01", None), (None, "2021-05-01", None), (1, "2020-01-01", None)], "k long, valid_from string, valid_to string"
    ).select("k", F.col("valid_from").cast("timestamp_ntz"), F.col("valid_to").cast("timestamp_ntz"))
    assert overlap_failures(df, "k").count() == 1


def test_a_key_that_the_cast_loses_is_no_row(spark):
    raw = spark.createDataFrame([("x1", "n", None, None, None, None), ("2", "n", None, None, None, None)], CLIENTS.raw_schema())
    assert rows(conform(raw, CLIENTS, strict=False).select("customer_id")) == [(2,)]


def test_full_load_reads_quotes(spark, tmp_path):
    write_file(tmp_path, "c.csv", HEADER.rsplit(",", 1)[0], '1,"Bob ""B"" Lee",,BR,2020-01-01,vip')
    assert read_full_load(spark, str(tmp_path), CLIENTS).first()["name"] == 'Bob "B" Lee'


def test_a_merge_writes_the_slices_it_touches(spark, tmp_path):
    table = Lakehouse(spark, str(tmp_path / "lake")).sliced("silver.sliced", "id", 8)
    assert not table.exists() and table.last_batch() is None
    table.overwrite(spark.range(1000).select("id", F.lit("a").alias("v")))
    assert table.exists()

    def files():
        return {p.relative_to(table.path) for p in Path(table.path).rglob("*.parquet") if "_slice=" in str(p)}

    before = files()
    batch = spark.createDataFrame([(1, "b", "U"), (2, None, "D"), (5000, "n", "I")], "id long, v string, _cdc_op string")
    table.merge(batch.select(F.col("id").cast("int")), lambda now: merge_changes(now, batch, "id"), batch=4)
    assert len({p.parts[1] for p in before}) == 8
    assert 1 <= len({p.parts[1] for p in before - files()}) <= 3  # all other slices keep their files
    got = dict(rows(table.read()))
    assert len(got) == 1000 and got[1] == "b" and got[5000] == "n" and 2 not in got and got[3] == "a"
    assert table.last_batch() == 4
    table.register()
    assert dict(rows(spark.table("silver.sliced"))) == got
    # A batch that is merged again changes nothing; one without keys writes nothing.
    table.merge(batch.select("id"), lambda now: merge_changes(now, batch, "id"))
    assert dict(rows(table.read())) == got
    last = files()
    table.merge(batch.select("id").limit(0), lambda now: now)
    assert files() == last
    # Slices that lose all their rows are replaced too.
    table.merge(spark.range(6000).select("id"), lambda now: now.limit(0))
    assert table.read().count() == 0
    table.register()
    assert spark.table("silver.sliced").count() == 0
    assert "_slice" in plan_of(table.read([3])).split("PartitionFilters: [")[1].split("]")[0]
