import os

import pytest
from pyspark.sql import functions as F
from support import rows, same, write_file

from strata.operators.changes import merge_changes
from strata.operators.conform import conform
from strata.plans.models import portfolio_versions
from strata.schema import CLIENTS, PORTFOLIOS, SOURCE_FILE
from strata.sources.files import read_change_files
from strata.sources.tables import Lakehouse
from strata.streaming.files import apply_change_files, apply_snapshot_files

HEADER = "customer_id,name,email,country,signup_date,segment,_cdc_op"


def line(key, name, op):
    return f"{key},{name},,BR,2020-01-01,vip,{op}"


@pytest.fixture
def clients(spark, tmp_path):
    table = Lakehouse(spark, str(tmp_path / "lake")).table("silver.stg_clients")
    rows = [(str(k), f"n{k}", None, "br", "2020-01-01", "vip") for k in range(4)]
    raw = spark.createDataFrame(rows, CLIENTS.raw_schema())
    table.overwrite(conform(raw, CLIENTS, "2026-01-01 00:00:00"))
    return table


def take_in(spark, tmp_path, table, **kw):
    query = apply_change_files(
        spark,
        str(tmp_path / "cdc"),
        CLIENTS,
        table,
        str(tmp_path / "checkpoint"),
        preserve=["ingestion_time"],
        **kw,
    )
    query.awaitTermination()


def names(table):
    return dict(rows(table.read().select("customer_id", "name")))


def test_files_are_applied_once_and_in_order(spark, tmp_path, clients):
    write_file(tmp_path / "cdc", "1.csv", HEADER, line(1, "first", "U"), line(2, "", "D"))
    take_in(spark, tmp_path, clients)
    assert names(clients) == {0: "n0", 1: "first", 3: "n3"}
    take_in(spark, tmp_path, clients)
    assert clients.versions() == [0, 1]  # nothing new
    write_file(tmp_path / "cdc", "2.csv", HEADER, line(1, "second", "U"), line(2, "back", "I"))
    take_in(spark, tmp_path, clients)
    assert names(clients) == {0: "n0", 1: "second", 2: "back", 3: "n3"}
    assert clients.last_batch() == 1


def test_replayed_batch_is_skipped(spark, tmp_path, clients):
    write_file(tmp_path / "cdc", "1.csv", HEADER, line(1, "first", "U"))
    take_in(spark, tmp_path, clients)
    write_file(tmp_path / "cdc", "2.csv", HEADER, line(1, "second", "U"))
    take_in(spark, tmp_path, clients)
    # The mark of a finished batch is lost, as after a crash between write and commit.
    for mark in (tmp_path / "checkpoint" / "commits").glob("*1*"):
        mark.unlink()
    take_in(spark, tmp_path, clients)
    assert clients.versions() == [0, 1, 2] and names(clients)[1] == "second"


def test_same_key_in_two_files_of_one_batch(spark, tmp_path, clients):
    write_file(tmp_path / "cdc", "b.csv", HEADER, line(1, "late", "U"), line(2, "", "D"))
    write_file(tmp_path / "cdc", "a.csv", HEADER, line(1, "early", "U"), line(2, "gone soon", "U"))
    take_in(spark, tmp_path, clients)
    assert clients.versions() == [0, 1]
    assert names(clients) == {0: "n0", 1: "late", 3: "n3"}


def test_one_file_per_batch(spark, tmp_path, clients):
    for n in range(3):
        write_file(tmp_path / "cdc", f"{n}.csv", HEADER, line(n, f"v{n}", "U"))
    take_in(spark, tmp_path, clients, max_files=1)
    assert clients.versions() == [0, 1, 2, 3]


def test_stream_equals_batch(spark, tmp_path, clients):
    write_file(tmp_path / "cdc", "1.csv", HEADER, line(1, "x", "U"), line(3, "", "D"), line(8, "y", "I"))
    changes = read_change_files(spark, str(tmp_path / "cdc"), CLIENTS)
    at = "2026-02-01 00:00:00"
    want = merge_changes(
        clients.read(),
        conform(changes, CLIENTS, at, changes=True, keep=[SOURCE_FILE]),
        "customer_id",
        preserve=["ingestion_time"],
        order_by=[SOURCE_FILE],
    )
    expected = rows(want)
    take_in(spark, tmp_path, clients, clock=lambda: at)
    assert rows(clients.read()) == expected


def test_finished_files_are_archived(spark, tmp_path, clients):
    archive = tmp_path / "applied"
    for n in range(3):
        write_file(tmp_path / "cdc", f"{n}.csv", HEADER, line(n, f"v{n}", "U"))
        take_in(spark, tmp_path, clients, archive=str(archive))
    moved = sorted(p.name for p in archive.rglob("*.csv"))
    assert moved and moved[0] == "0.csv"  # archiving lags behind
    assert names(clients) == {0: "v0", 1: "v1", 2: "v2", 3: "n3"}


PORTFOLIO_HEADER = ",".join(PORTFOLIOS.columns)


def test_snapshots_become_rounds(spark, tmp_path):
    dim = Lakehouse(spark, str(tmp_path / "lake")).history("silver.dim_client_portfolio")

    def take(name, *lines):
        write_file(tmp_path / "in", name, PORTFOLIO_HEADER, *lines)
        apply_snapshot_files(
            spark,
            str(tmp_path / "in"),
            PORTFOLIOS,
            dim,
            str(tmp_path / "checkpoint"),
            portfolio_versions,
        ).awaitTermination()

    take("0.csv", "1,1,P,1,M,br,gold", "2,1,P,1,M,br,gold")
    take("1.csv", "1,2,P,1,M,br,gold")
    versions = dim.read()
    assert rows(versions.select("customer_id", "portfolio_id", "is_current")) == [
        (1, 1, False),
        (1, 2, True),
        (2, 1, False),
    ]
    # Ends equal starts, and both are the file's time.
    ends = versions.filter("not is_current").select(F.col("valid_to").alias("t")).distinct()
    same(ends, versions.filter("is_current").select(F.col("valid_from").alias("t")))


def test_a_change_delivered_again_counts_once(spark, tmp_path, clients):
    """In a later file of the same run, in a later run, and after a restart of the stream."""
    header = HEADER + ",seq"

    def deliver(name, *changes):
        write_file(tmp_path / "cdc", name, header, *(f"{line(k, v, 'U')},{n}" for k, v, n in changes))
        os.utime(tmp_path / "cdc" / name, (1.7e9 + int(name[0]),) * 2)  # files of one instant have no order

    def run():
        take_in(spark, tmp_path, clients, max_files=1, extra=["seq"], once_by=["customer_id", "seq"])

    deliver("1.csv", (1, "first", 1), (2, "two", 1))
    deliver("2.csv", (1, "second", 2))
    deliver("3.csv", (1, "first", 1))  # again, after its successor
    run()
    assert names(clients) == {0: "n0", 1: "second", 2: "two", 3: "n3"}
    versions = clients.versions()
    deliver("4.csv", (1, "first", 1), (1, "second", 2), (2, "two", 1))
    run()
    assert names(clients)[1] == "second" and clients.versions() == versions  # nothing new, nothing written
    deliver("5.csv", (2, "two", 1), (2, "three", 2))
    run()
    assert names(clients) == {0: "n0", 1: "second", 2: "three", 3: "n3"}


def test_what_was_taken_in_is_forgotten_in_time(spark, tmp_path, clients):
    """The state holds the span asked for; what comes again after it counts again."""
    import time

    def run(name, *changes):
        write_file(tmp_path / "cdc", name, HEADER + ",seq", *(f"{line(k, v, 'U')},{n}" for k, v, n in changes))
        query = apply_change_files(
            spark, str(tmp_path / "cdc"), CLIENTS, clients, str(tmp_path / "checkpoint"),
            preserve=["ingestion_time"], extra=["seq"], once_by=["customer_id", "seq"], within="1 second",
        )
        query.awaitTermination()
        states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
        return states[-1] if states else 0

    for n in range(4):
        run(f"{n}.csv", *((k, f"v{n}", n) for k in range(4)))
        time.sleep(2)
    assert run("9.csv", (0, "again", 0)) <= 5  # not one entry for every change ever seen
    assert names(clients)[0] == "again"


def test_broken_lines_are_kept_beside_the_table(spark, tmp_path, clients):
    rejects = tmp_path / "rejects"
    write_file(tmp_path / "cdc", "1.csv", HEADER, line(1, "first", "U"), "2,too,few", line(3, '"open', "U"))
    write_file(tmp_path / "cdc", "2.csv", HEADER, line(0, "more", "U") + ",x")
    take_in(spark, tmp_path, clients, max_files=1, rejects=str(rejects))
    assert names(clients) == {0: "n0", 1: "first", 2: "n2", 3: "n3"}
    kept = spark.read.parquet(str(rejects)).select("line", SOURCE_FILE)
    assert rows(kept) == sorted(
        [("2,too,few", "1.csv"), (line(3, '"open', "U"), "1.csv"), (line(0, "more", "U") + ",x", "2.csv")], key=repr
    )
    take_in(spark, tmp_path, clients, rejects=str(rejects))  # nothing new
    assert kept.count() == 3


def test_broken_lines_end_a_stream_without_a_place_for_them(spark, tmp_path, clients):
    write_file(tmp_path / "cdc", "1.csv", HEADER, line(1, "first", "U"), "2,too,few")
    with pytest.raises(Exception, match="(?i)malformed"):
        take_in(spark, tmp_path, clients)
    assert names(clients)[1] == "n1"
