from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from support import rows, same, write_file

from strata.operators.conform import conform, split_rejects
from strata.schema import CLIENTS, INVENTORY, ORDERS, PORTFOLIOS, SOURCE_FILE
from strata.sources.files import (
    land,
    read_change_files,
    read_full_load,
    replace_snapshot,
    write_csv,
    write_parquet,
)

HEADER = "product_id,warehouse_id,category,quantity_on_hand,unit_cost,last_restock_date,status"


def test_full_load_ignores_the_change_folder(spark, tmp_path):
    write_file(tmp_path / "inventory", "a.csv", HEADER, "1,2, Toys ,3,4.50,2026-01-01, ACTIVE ")
    write_file(tmp_path / "inventory", "b.csv", HEADER, "2,2,Home,,,,")
    write_file(tmp_path / "inventory" / "cdc", "c.csv", HEADER + ",_cdc_op", "3,2,Home,,,,,I")
    raw = read_full_load(spark, str(tmp_path / "inventory"), INVENTORY)
    assert rows(conform(raw, INVENTORY)) == [
        (1, 2, "Toys", 3, Decimal("4.50"), date(2026, 1, 1), "active"),
        (2, 2, "Home", None, None, None, None),
    ]
    changes = read_change_files(spark, str(tmp_path / "inventory" / "cdc"), INVENTORY)
    assert changes.select("product_id", "_cdc_op", SOURCE_FILE).first() == ("3", "I", "c.csv")


def test_header_that_does_not_fit_is_an_error(spark, tmp_path):
    write_file(tmp_path, "a.csv", HEADER.replace("category", "kind"), "1,2,Toys,3,4.50,2026-01-01,x")
    with pytest.raises(Exception, match="(?i)header"):
        read_full_load(spark, str(tmp_path), INVENTORY).collect()


def test_landing(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path"):
        land(spark, str(tmp_path / "none"), str(tmp_path / "landed"), INVENTORY, date(2026, 1, 1))
    write_file(tmp_path / "in", "a.csv", HEADER, "1,2,Toys,3,4.50,2026-01-01,x")
    first = land(spark, str(tmp_path / "in"), str(tmp_path / "landed"), INVENTORY, date(2026, 1, 1))
    land(spark, str(tmp_path / "in"), str(tmp_path / "landed"), INVENTORY, date(2026, 1, 2))
    assert first.select("product_id", SOURCE_FILE).first() == ("1", "a.csv")
    landed = spark.read.parquet(str(tmp_path / "landed"))
    assert rows(landed.groupBy("_ingest_date").count()) == [
        (date(2026, 1, 1), 1),
        (date(2026, 1, 2), 1),
    ]


def test_csv_round_trip_keeps_blanks_and_nulls(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", " a,b ", None, 'x"y', "2020-01-01", "VIP ")], CLIENTS.raw_schema()
    )
    write_csv(raw, str(tmp_path / "c"))
    same(read_full_load(spark, str(tmp_path / "c"), CLIENTS), raw)


def test_snapshot_is_replaced_by_rows_read_from_itself(spark, tmp_path):
    path = str(tmp_path / "p")
    raw = spark.createDataFrame([(str(i),) + ("1",) * 6 for i in range(4)], PORTFOLIOS.raw_schema())
    write_csv(raw, path)
    kept = read_full_load(spark, path, PORTFOLIOS).filter("customer_id <> '0'")
    replace_snapshot(kept, path)
    assert read_full_load(spark, path, PORTFOLIOS).count() == 3


def test_parquet_result_is_counted_while_written(spark, tmp_path):
    assert write_parquet(spark.range(123), str(tmp_path / "r")) == 123
    assert write_parquet(spark.range(0), str(tmp_path / "e")) == 0
    assert spark.read.parquet(str(tmp_path / "r")).count() == 123


def orders(spark, **changed):
    row = dict(zip(ORDERS.columns, ("1", "2", "3", "4", "2026-01-05", "1.005", " Paid ")))
    row.update(changed)
    return spark.createDataFrame([tuple(row.values())], ORDERS.raw_schema())


def test_text_is_trimmed_of_blanks_only(spark):
    got = conform(orders(spark, status="\tPaid  "), ORDERS).first()
    assert got["status"] == "\tpaid"


def test_audit_columns_are_one_instant(spark):
    at = datetime(2026, 1, 1, 3, tzinfo=timezone.utc)
    got = conform(orders(spark), ORDERS, at)
    kinds = dict(got.dtypes)
    assert kinds["ingestion_time"] == kinds["last_updated_time"] == "timestamp"
    assert got.select((F.col("ingestion_time") == F.lit(at)).alias("x")).first()["x"]


def test_rows_without_a_key_are_dropped(spark):
    assert conform(orders(spark, order_id=None), ORDERS).count() == 0


@pytest.mark.parametrize(
    "column,value", [("amount", "n/a"), ("quantity", "1.5"), ("order_date", "soon"), ("order_id", "x")]
)
def test_bad_values_raise_or_are_kept_apart(spark, column, value):
    raw = orders(spark, **{column: value})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(raw, ORDERS).collect()
    fits, rejects = split_rejects(raw, ORDERS)
    assert fits.count() == 0
    assert rejects.first()["rejected_columns"] == column


def test_good_rows_have_no_rejects(spark):
    fits, rejects = split_rejects(orders(spark), ORDERS)
    assert fits.columns == ORDERS.columns and fits.count() == 1 and rejects.count() == 0


def test_lines_of_another_shape_are_kept_apart(spark, tmp_path):
    from strata.sources.files import read_csv_apart

    good = ['1,2," Toys ",3,4.50,2026-01-01,"say ""hi"", all"', "2,2,Home,,,,", '3,2,"a,b",,,,plain "inner" quote']
    bad = ["4,2,Home", "5,2,Home,,,,active,more", '6,2,"open,3,4.50,2026-01-01,x', '7,"open,Home,3,4.50,2026-01-01,"x"']
    write_file(tmp_path / "in", "a.csv", HEADER, good[0], bad[0], good[1], bad[1])
    write_file(tmp_path / "in", "b.csv", HEADER, bad[2], good[2], bad[3])
    rows_, lines = read_csv_apart(spark, str(tmp_path / "in"), INVENTORY.raw_schema())
    assert rows(rows_.select("product_id", "category", "status")) == [
        ("1", " Toys ", 'say "hi", all'),
        ("2", "Home", None),
        ("3", "a,b", 'plain "inner" quote'),
    ]
    assert rows(lines.select("line", SOURCE_FILE)) == sorted(zip(bad, ["a.csv", "a.csv", "b.csv", "b.csv"]), key=repr)
    places = {r["line"]: (r["block_start"], r["block_length"]) for r in lines.collect()}
    size = (tmp_path / "in" / "a.csv").stat().st_size
    assert places[bad[0]] == (0, size)
    # Counts that ask for no column, and for one.
    assert (rows_.count(), lines.count()) == (3, 4)
    assert rows(rows_.select("category").filter("category is not null")) == [(" Toys ",), ("Home",), ("a,b",)]
    assert rows(conform(rows_, INVENTORY).select("product_id", "status"))[1:] == [(2, None), (3, 'plain "inner" quote')]


def test_a_header_that_does_not_fit_is_still_an_error(spark, tmp_path):
    from strata.sources.files import read_csv_apart

    write_file(tmp_path, "a.csv", HEADER.replace("category", "kind"), "1,2,Toys,3,4.50,2026-01-01,x")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_apart(spark, str(tmp_path), INVENTORY.raw_schema())[0].collect()
