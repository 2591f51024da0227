"""The stored tables: replacement, upsert rules, schema changes and layout."""

import os

import pytest
from conftest import day, order, records
from pyspark.sql import functions as F

from martloom.operators import tables
from martloom.operators.tables import DuplicateKeyError, MonthlyTable, SnapshotTable
from martloom.plans.models import Models
from martloom.plans.pipeline import refresh_orders
from martloom.session import shared_folder

SCHEMA = "order_id bigint, store_id bigint, order_status int, order_date date, note string"


def rows(spark, *items):
    data = [(i, 1, s, day(d), n) for i, s, d, n in items]
    return spark.createDataFrame(data, SCHEMA)


def seen(table):
    return records(table.read(), "order_id", "order_status", "order_date", "note")


@pytest.fixture
def table(spark, tmp_path):
    table = MonthlyTable(spark, str(tmp_path / "orders"))
    table.replace(
        rows(
            spark,
            (1, 1, "2016-01-05", "a"),
            (2, 1, "2016-02-10", "b"),
            (3, 1, "2016-02-20", "c"),
            (4, 1, None, "d"),
        )
    )
    return table


def history(make_sources, spark, tmp_path, first, second, **more):
    """Two runs of the order history: a first load and a later one."""
    table = MonthlyTable(spark, str(tmp_path / "history"))
    refresh_orders(Models(make_sources(orders=first, **more)), table)
    refresh_orders(Models(make_sources(orders=second, **more)), table)
    return records(table.read(), "order_id", "order_status", "order_date")


def test_new_and_recent_rows_load_old_changes_do_not(make_sources, spark, tmp_path):
    first = [order(1, status=1, date="2016-01-01"), order(2, status=1, date="2016-01-20"),
             order(3, status=1, date="2016-01-13"), order(7, status=1, date="2016-01-12")]
    second = [order(1, status=4, date="2016-01-01"), order(2, status=4, date="2016-01-20"),
              order(3, status=4, date="2016-01-13"), order(7, status=4, date="2016-01-12"),
              order(5, status=1, date="2016-02-02"), order(6, date="2016-01-02")]
    assert history(make_sources, spark, tmp_path, first, second) == [
        (1, 1, day("2016-01-01")),
        (2, 4, day("2016-01-20")),
        (3, 4, day("2016-01-13")),
        (5, 1, day("2016-02-02")),
        (7, 1, day("2016-01-12")),
    ]


def test_rows_without_a_date_load_on_full_refresh_only(make_sources, spark, tmp_path):
    undated = (9, 1, 1, 1, 4, None, None, "NULL")
    first = [order(1, date="2016-01-01")]
    assert history(make_sources, spark, tmp_path, first, [*first, undated]) == [
        (1, 4, day("2016-01-01"))
    ]
    table = MonthlyTable(spark, str(tmp_path / "history"))
    refresh_orders(Models(make_sources(orders=[*first, undated])), table, full_refresh=True)
    assert table.read().count() == 2


def test_an_empty_table_takes_nothing(make_sources, spark, tmp_path):
    assert history(make_sources, spark, tmp_path, [], [order(1)]) == []


def test_deleted_orders_stay(make_sources, spark, tmp_path):
    first = [order(1, date="2016-01-10"), order(2, date="2016-01-11")]
    assert len(history(make_sources, spark, tmp_path, first, first[:1])) == 2


def test_duplicate_keys_are_refused(spark, table):
    before = seen(table)
    with pytest.raises(DuplicateKeyError):
        table.merge(rows(spark, (8, 1, "2016-02-21", "x"), (8, 2, "2016-02-22", "y")))
    assert seen(table) == before


def test_a_row_leaves_its_old_month(spark, table):
    table.merge(rows(spark, (1, 2, "2016-02-25", "moved")))
    assert seen(table) == [
        (1, 2, day("2016-02-25"), "moved"),
        (2, 1, day("2016-02-10"), "b"),
        (3, 1, day("2016-02-20"), "c"),
        (4, 1, None, "d"),
    ]
    assert sorted(table._state(table._version())["months"]) == ["2016-02", "__HIVE_DEFAULT_PARTITION__"]


def test_rows_without_a_key_are_added(spark, table):
    table.merge(rows(spark, (None, 1, "2016-02-21", "x"), (None, 1, "2016-02-22", "y")))
    table.merge(rows(spark, (None, 1, "2016-02-23", "z")))
    assert table.read().where("order_id IS NULL").count() == 3 and len(seen(table)) == 7


def test_untouched_months_are_not_written_again(spark, table):
    table.merge(rows(spark, (9, 1, "2016-03-01", "new")))
    months = table._state(table._version())["months"]
    assert months["2016-03"] > months["2016-01"] == months["2016-02"]


def test_columns_follow_the_batch(spark, table):
    batch = rows(spark, (3, 2, "2016-02-20", "x")).drop("note").withColumn("extra", F.lit(1))
    table.merge(batch)
    assert table.read().columns == ["order_id", "store_id", "order_status", "order_date", "extra"]
    assert records(table.read(), "order_id", "extra") == [(1, None), (2, None), (3, 1), (4, None)]


def test_a_dropped_column_comes_back_empty(spark, table):
    table.merge(rows(spark, (3, 2, "2016-02-20", "x")).drop("note"))
    table.merge(rows(spark, (3, 2, "2016-02-20", "again")))
    assert records(table.read(), "order_id", "note") == [(1, None), (2, None), (3, "again"), (4, None)]


def test_a_column_may_change_its_type(spark, table):
    batch = rows(spark, (3, 2, "2016-02-20", "x")).withColumn("order_status", F.lit("two"))
    table.merge(batch)
    assert records(table.read(), "order_id", "order_status") == [
        (1, "1"), (2, "1"), (3, "two"), (4, "1"),
    ]


def test_upsert_twice_changes_nothing(spark, table):
    batch = rows(spark, (3, 2, "2016-02-20", "x"), (5, 1, "2016-02-21", "y"))
    table.merge(batch)
    once = seen(table)
    table.merge(batch)
    assert seen(table) == once


def test_a_failed_run_leaves_the_table_as_it_was(spark, table):
    before = seen(table)
    broken = rows(spark, (3, 2, "2016-02-20", "x")).withColumn(
        "note", F.raise_error(F.lit("broken")).cast("string")
    )
    with pytest.raises(Exception, match="broken"):
        table.replace(broken)
    assert seen(table) == before
    table.merge(rows(spark, (5, 1, "2016-02-21", "y")))
    assert len(seen(table)) == 5


def test_a_second_writer_is_refused(spark, table):
    with pytest.raises(RuntimeError, match="another writer"):
        table._publish(table._version() - 1, {})
    assert len(seen(table)) == 4


def test_a_writer_that_started_earlier_loses(spark, table):
    """Two upserts of the same version: the later one must not undo the earlier one."""
    slow = MonthlyTable(spark, table.root)
    reject = slow._reject_duplicates
    slow._version = lambda version=table._version(): version
    slow._reject_duplicates = lambda batch: (
        table.merge(rows(spark, (7, 1, "2016-02-02", "fast"))), reject(batch)
    )
    with pytest.raises(RuntimeError, match="another writer"):
        slow.merge(rows(spark, (8, 1, "2016-02-02", "slow")))
    assert [r[0] for r in seen(table)] == [1, 2, 3, 4, 7]


def test_old_data_can_be_removed(spark, table):
    table.merge(rows(spark, (5, 1, "2016-02-21", "y")))
    table.merge(rows(spark, (6, 1, "2016-02-22", "z")))
    before = seen(table)
    table.remove_old(versions=1)
    assert seen(table) == before
    numbers = sorted(s.split("-")[0] for s in table._snapshots())
    assert numbers == ["1", "3"] and table._versions() == [3]
    table.merge(rows(spark, (7, 1, "2016-01-22", "w")))
    assert len(seen(table)) == 7


def test_upserts_leave_no_temporary_tables(spark, table):
    folder = os.path.join(shared_folder(spark), "martloom")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    table.merge(rows(spark, (5, 1, "2016-02-21", "y")))
    assert set(os.listdir(folder)) == before


def test_reading_since_a_day_opens_later_months_only(spark, table):
    recent = table.read(since=day("2016-02-15"))
    assert records(recent, "order_id") == [(3,)]
    assert all("order_month=2016-02" in f for f in recent.inputFiles())


def test_layout_by_month_sorted_by_cluster_columns(spark, tmp_path):
    df = spark.range(2000).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 7).alias("store_id"),
        (F.col("id") % 4 + 1).cast("int").alias("order_status"),
        F.date_add(F.lit(day("2016-01-01")), (F.col("id") % 60).cast("int")).alias("order_date"),
    )
    table = MonthlyTable(spark, str(tmp_path / "t"))
    table.replace(df)
    (snapshot,) = os.listdir(tmp_path / "t/data")
    folders = [n for n in os.listdir(tmp_path / "t/data" / snapshot) if n.startswith("order_month")]
    assert sorted(folders) == ["order_month=2016-01", "order_month=2016-02"]
    for path in table.read().inputFiles():
        keys = [(r[0], r[1]) for r in spark.read.parquet(path).select("store_id", "order_status").collect()]
        assert keys == sorted(keys)
    assert records(table.read()) == records(df)


def test_replaced_table(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    table.replace(spark.range(3))
    table.replace(table.read().where("id > 0"))
    assert records(table.read()) == [(1,), (2,)]
    table.replace(spark.range(0))
    assert records(table.read()) == []


def test_full_refresh_refuses_a_key_twice(spark, tmp_path):
    table = MonthlyTable(spark, str(tmp_path / "dup"))
    schema = "order_id long, order_date date, store_id long, order_status int"
    row = (1, day("2016-01-10"), 1, 4)
    with pytest.raises(DuplicateKeyError):
        table.replace(spark.createDataFrame([row, row], schema))
    assert not table.exists()
    table.replace(spark.createDataFrame([row], schema))
    with pytest.raises(DuplicateKeyError):
        table.replace(spark.createDataFrame([row, row], schema))
    assert table.read().count() == 1


def test_a_batch_is_written_again_only_if_some_of_it_is_old(spark, tmp_path, monkeypatch):
    kept = []

    def noted(df, name="kept", keep=tables.keep):
        kept.append(name)
        return keep(df, name)

    def numbered(*some):
        return spark.createDataFrame(
            [(i, day("2020-01-01"), s) for i, s in some],
            "order_id bigint, order_date date, _sequence int",
        )

    table = MonthlyTable(spark, str(tmp_path / "t"), cluster_by=())
    table.replace(numbered((1, 5), (2, 5), (3, None)))
    monkeypatch.setattr(tables, "keep", noted)
    table.merge(numbered((1, 6), (2, 5), (3, 1), (4, None)))
    assert "newer" not in kept
    table.merge(numbered((1, 5), (2, 7), (None, 9)))
    assert "newer" in kept
    state = table._state(table._version())
    got = table._read_months(state, state["months"])
    assert records(got, "order_id", "_sequence") == [(1, 6), (2, 7), (3, 1), (4, None), (None, 9)]
