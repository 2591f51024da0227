import datetime as dt
import os

import pytest
from conftest import day, order, records
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from martloom.operators.tables import MonthlyTable
from martloom.plans import checks, pipeline
from martloom.plans.models import Models
from martloom.sources import read_tables, with_tables
from martloom.streaming.order_feed import newest_per_key, start_order_feed

ITEMS = [(i, 1, 10, i, 10.0, 0.0) for i in range(1, 9)]


def test_build_writes_all_marts_and_they_pass(spark, small, tmp_path):
    tables = pipeline.build(spark, small, str(tmp_path), env="prod")
    models = Models(small)
    assert sorted(os.listdir(tmp_path / "prod/mart")) == sorted(["orders", *pipeline.TABLES])
    for name, table in tables.items():
        assert records(table.read()) == records(getattr(models, name))
    failed = pipeline.validate(small, tables).where("status = 'fail'").collect()
    # A store's month in which no completed order has lines has no revenue.
    empty = models.revenue_by_store.where("total_revenue IS NULL").count()
    assert {(r.model, r.column_name): r.failures for r in failed} == (
        {("revenue_by_store", "total_revenue"): empty} if empty else {}
    )
    assert spark.sql("SELECT count(*) FROM prod_intermediate_int_orders_enriched").first()[0] == models.stg_orders.count()


def test_a_build_counts_its_checks_while_it_writes(spark, make_sources, tmp_path):
    """Planted failures are found by observation, with the figures of the checks that scan."""
    rows = [order(1), order(2, status=9), order(3, shipped="2016-01-01"), order(4, date=None)]
    lines = [(1, 1, 10, 2, 10.0, 0.1), (1, 2, 11, 0, 5.0, 0.0), (3, 1, None, 1, 5.0, 1.5)]
    sources = make_sources(orders=rows, order_items=lines)
    watch = checks.BuildChecks()
    tables = pipeline.build(spark, sources, str(tmp_path), watch=watch)
    keys = ("model", "test", "column_name", "failures", "status")
    got = {tuple(r[k] for k in keys[:3]): (r.failures, r.status) for r in watch.outcomes(spark).collect()}
    full = pipeline.validate(sources, tables).select(*keys).collect()
    want = {tuple(r[k] for k in keys[:3]): (r.failures, r.status) for r in full}
    explosion = ("orders", "int_orders_no_row_explosion", "stg_orders")
    assert got.pop(explosion) == (0, "pass")
    kinds = {"not_null", "accepted_values", *[r.name for r in checks.domain_rules()]}
    models = set(checks.BuildChecks.MODELS)
    assert got == {k: v for k, v in want.items() if k[0] in models and k[1] in kinds}
    assert {k[0] for k, v in got.items() if v[1] == "fail"} >= {"stg_orders", "stg_order_items", "orders"}
    # Later builds observe the months they write, and have no number of orders to compare.
    again = checks.BuildChecks()
    pipeline.build(spark, sources, str(tmp_path), watch=again)
    assert explosion not in {tuple(r[k] for k in keys[:3]) for r in again.outcomes(spark).collect()}


def test_a_build_reads_the_lines_once(spark, make_sources, tmp_path):
    """After the lines' sums are kept, no mart reads the lines, and all are as without."""
    lines = [(i, n, 10 + n % 3, n + 1, 10.0, 0.1) for i in range(1, 7) for n in range(5)]
    orders = [order(i, status=4 if i % 3 else 2, date=f"2016-0{i}-10") for i in range(1, 6)]
    for name, df in make_sources(orders=orders, order_items=[*lines, (1, 9, None, 1, 1.0, 0.0)]).items():
        df.write.parquet(str(tmp_path / name))
    sources = read_tables(spark, str(tmp_path))
    plain, kept = Models(sources), Models(sources)
    kept.keep_line_sums()
    kept.keep_order_facts()
    for name in ("orders", *pipeline.TABLES):
        mart = getattr(kept, name)
        assert not [f for f in mart.inputFiles() if "/order_items/" in f], name
        assert mart.dtypes == getattr(plain, name).dtypes
        assert records(mart) == records(getattr(plain, name)), name


def test_second_build_is_incremental_and_equal(spark, small, tmp_path):
    tables = pipeline.build(spark, small, str(tmp_path))
    first = records(tables["orders"].read())
    again = pipeline.build(spark, small, str(tmp_path))
    assert records(again["orders"].read()) == first
    table = again["orders"]
    assert {s.split("-")[0] for s in table._snapshots_in(table._state(2))} == {"1", "2"}


def test_descriptions_are_stored(spark, small, tmp_path):
    table = MonthlyTable(spark, str(tmp_path / "orders"))
    pipeline.refresh_orders(Models(small), table)
    assert "required" in table.read().schema["delivery_delay_days"].metadata["comment"]


def test_stored_sources(spark, make_sources, tmp_path):
    sources = make_sources(orders=[order(1)], order_items=ITEMS[:1])
    for name, df in sources.items():
        df.write.parquet(str(tmp_path / name))
    stored = Models(read_tables(spark, str(tmp_path)))
    assert records(stored.orders) == records(Models(sources).orders)
    with pytest.raises(KeyError):
        stored.sources["nothing"]


@settings(
    max_examples=3,
    deadline=None,
    phases=[Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.dictionaries(st.integers(1, 8), st.tuples(st.integers(1, 4), st.integers(0, 6)), min_size=1),
        min_size=2,
        max_size=3,
    )
)
def test_runs_within_the_window_equal_a_full_refresh(spark, make_sources, tmp_path, batches):
    """As long as no order is older than the window, later runs miss nothing."""
    root = tmp_path / f"t{dt.datetime.now().timestamp()}"
    table = MonthlyTable(spark, str(root))
    known = {}
    for batch in batches:
        known.update(batch)
        rows = [
            order(i, status=s, date=str(day("2016-01-28") + dt.timedelta(d)))
            for i, (s, d) in known.items()
        ]
        models = Models(make_sources(orders=rows, order_items=ITEMS))
        pipeline.refresh_orders(models, table)
    assert records(table.read()) == records(models.orders)


def test_order_feed_takes_the_last_update(spark, make_sources, tmp_path):
    sources = make_sources(orders=[], order_items=ITEMS)
    table = MonthlyTable(spark, str(tmp_path / "orders"))

    def deliver(*updates):
        rows = [(*o, seq) for o, seq in updates]
        schema = sources["orders"].schema.simpleString()[7:-1] + ",updated_at:int"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in")
        )

    def run():
        schema = spark.read.parquet(str(tmp_path / "in")).schema
        updates = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        start_order_feed(updates, sources, table, str(tmp_path / "cp")).awaitTermination()

    deliver((order(1, status=1), 1), (order(1, status=2), 3), (order(1, status=3), 2), (order(2), 1))
    run()
    assert records(table.read(), "order_id", "order_status", "order_revenue") == [
        (1, 2, None),
        (2, 4, 20.0),
    ]
    deliver((order(1, status=4, date="2016-03-01"), 4), (order(3, status=1), 1))
    run()
    assert records(table.read(), "order_id", "order_status", "order_date") == [
        (1, 4, day("2016-03-01")),
        (2, 4, day("2016-01-10")),
        (3, 1, day("2016-01-10")),
    ]


@pytest.mark.parametrize("stored_totals", [False, True])
def test_late_updates_never_replace_newer_ones(spark, make_sources, tmp_path, stored_totals):
    """Across deliveries, with and without stored totals; a batch job in between keeps order."""
    sources = make_sources(orders=[], order_items=ITEMS)
    table = MonthlyTable(spark, str(tmp_path / "orders"))
    totals = Models(sources).order_totals if stored_totals else None
    if stored_totals:
        sources = {n: f for n, f in sources.items() if n != "order_items"}
    schema = sources["orders"].schema.simpleString()[7:-1] + ",updated_at:int"
    deliveries = [
        [(order(1, status=4), 10), (order(2, status=1), 10)],
        [(order(1, status=1), 5), (order(2, status=4), 11), (order(3, status=2), 1)],
        [(order(2, status=3, date="2016-05-01"), 10), (order(3, status=4), 1)],
    ]
    for rows in deliveries:
        frame = spark.createDataFrame([(*o, seq) for o, seq in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        updates = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
        feed = start_order_feed(
            updates, sources, table, str(tmp_path / "cp"), order_totals=totals
        )
        feed.awaitTermination()
    got = records(table.read(), "order_id", "order_status", "order_date")
    assert got == [(i, 4, day("2016-01-10")) for i in (1, 2, 3)]
    assert "_sequence" not in table.read().columns


def test_upsert_reads_the_kept_facts(make_sources):
    models = Models(make_sources(orders=[order(1)], order_items=ITEMS))
    models.keep_order_facts()
    plan = models.orders.where("order_date > DATE'2016-01-01'")._jdf.queryExecution().toString()
    assert "order-facts" in plan or "list_price" not in plan


def test_views_carry_environment_and_layer(spark, make_sources):
    models = Models(make_sources(orders=[order(1)]))
    pipeline.register_views(models, "prod")
    assert spark.table("prod_staging_stg_orders").count() == 1
    assert spark.table("prod_intermediate_int_orders_enriched").count() == 1


def test_every_mart_column_and_relation_has_a_text(spark, make_sources, tmp_path):
    sources = make_sources(orders=[order(1)], order_items=ITEMS)
    for name, table in pipeline.build(spark, sources, str(tmp_path), env="prod").items():
        assert table.stored_comment()
        bare = [f.name for f in table.read().schema if not f.metadata.get("comment")]
        assert bare == [], (name, bare)
    for name in (*pipeline.STAGING_VIEWS, *pipeline.INTERMEDIATE_VIEWS):
        view = spark.table(pipeline.view_name("prod", name))
        assert [f.name for f in view.schema if not f.metadata.get("comment")] == [], name


def test_newest_per_key(spark):
    rows = [(1, "a", 1), (1, "b", 2), (2, "c", 1)]
    df = spark.createDataFrame(rows, "k int, v string, s int")
    assert records(newest_per_key(df, "k", "s")) == [(1, "b", 2), (2, "c", 1)]


def test_with_tables_replaces_and_keeps(small):
    none = small["orders"].limit(0)
    sources = with_tables(small, orders=none)
    assert sources["orders"] is none and sources["stores"].count() == 5
    assert small["orders"].count() == 1500
