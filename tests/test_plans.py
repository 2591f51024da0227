"""The plans Spark chooses: pruning, pushdown, shuffles and skew."""

import re

import pytest
from conftest import order, records
from pyspark.sql import functions as F

from martloom import session
from martloom.operators import ranking
from martloom.plans import kpis
from martloom.plans.models import Models
from martloom.sources import from_testdata, read_tables

ITEMS = [(1, 1, 10, 1, 5.0, 0.0)]


@pytest.fixture(scope="module")
def stored(spark, make_sources, tmp_path_factory):
    """Source tables stored under their own columns, as in production."""
    folder = tmp_path_factory.mktemp("sources")
    for name, df in make_sources(orders=[order(1)], order_items=ITEMS).items():
        df.write.parquet(str(folder / name))
    return read_tables(spark, str(folder))


@pytest.fixture
def no_broadcast(spark):
    """Plan as if every table were too large to broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """Columns read, by file scan."""
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^\n]*)>", physical(df))]


def test_scans_read_only_what_is_used(stored):
    columns = set().union(*scans(Models(stored).revenue_by_store))
    assert columns == {
        "order_id", "store_id", "order_status", "order_date", "quantity", "list_price", "discount",
        "store_name", "city", "state",
    }


def test_protected_columns_are_not_even_read(stored):
    columns = set().union(*scans(Models(stored).orders))
    assert not columns & {"email", "phone", "street", "zip_code"}


def test_status_filter_reaches_the_scan(stored):
    plan = physical(Models(stored).completed_orders)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(order_status,4\)", plan)


def test_stock_filter_reaches_the_scan(stored):
    assert re.search(
        r"PushedFilters: \[[^\]]*LessThanOrEqual\(quantity,5\)", physical(Models(stored).low_stock_analysis)
    )


@pytest.mark.parametrize("name", ["revenue_by_category", "late_deliveries_by_store"])
def test_unused_facts_are_not_computed(stored, name):
    """Neither needs customers, staff or, for deliveries, order lines."""
    columns = set().union(*scans(getattr(Models(stored), name)))
    assert not columns & {"first_name", "staff_id", "customer_id"}
    assert ("list_price" in columns) == (name == "revenue_by_category")


# Shuffles when no side can be broadcast: one per join side, and one per change of key.
SHUFFLES = {
    "revenue_by_store": 5,  # lines and orders by order, then small: months, stores
    "customer_summary": 4,  # lines and orders by order, customers twice
    "revenue_by_category": 8,
    "orders": 10,
}


@pytest.mark.parametrize("name", SHUFFLES)
def test_number_of_shuffles(stored, no_broadcast, name):
    plan = physical(getattr(Models(stored), name))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= SHUFFLES[name]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_distinct_orders_are_counted_without_a_shuffle(stored, no_broadcast):
    """Rows per customer and order are reduced where the order join left them."""
    plan = physical(Models(stored).customer_summary)
    assert "hashpartitioning(customer_id" in plan
    assert not re.search(r"hashpartitioning\(customer_id#\w+, order_id", plan)
    assert "Expand" not in plan


def test_hot_order_is_split(spark, make_sources, no_broadcast):
    """One order with most of the lines: its partition is split, the result stays whole."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    sources = dict(make_sources(orders=[order(i) for i in range(1, 400)]))
    sources["order_items"] = spark.range(0, 40_000, 1, 16).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 399 + 1).cast("bigint").alias("order_id"),
        F.col("id").alias("item_id"),
        (F.col("id") % 500).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(2.0).alias("list_price"),
        F.lit(0.0).alias("discount"),
    )
    models = Models(sources)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        from martloom.session import configure

        configure(spark)
        sales = models.product_sales
        got = records(sales, "product_id", "units_sold", "order_count")
        sales.collect()
        plan = physical(sales)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert "skew=true" in plan
    lines = sources["order_items"]
    want = lines.groupBy("product_id").agg(F.count("*"), F.count_distinct("order_id"))
    assert got == records(want)


def test_testdata_scans_are_pruned(spark):
    """The derived sources keep pruning: no key is computed unless it is shown."""
    models = Models(from_testdata(spark, "/root/testdata/sf0.001"))
    columns = set().union(*scans(models.revenue_by_store))
    assert not columns & {"l_tax", "l_returnflag", "l_suppkey", "l_partkey", "o_totalprice"}


def test_product_figures_read_the_stored_ranking(spark, tmp_path):
    """Analyses and figures on the stored mart agree with the rebuilt ones, without the lines."""
    from martloom.plans import analyses, kpis

    models = Models(from_testdata(spark, "/root/testdata/sf0.001"))
    models.top_products.write.parquet(str(tmp_path / "top"))
    stored = spark.read.parquet(str(tmp_path / "top"))
    stock = (models.stg_stocks, models.stg_stores)
    for build in (
        lambda sales: analyses.stock_top_products(sales, *stock),
        lambda sales: analyses.low_stock_analysis(sales, *stock),
        lambda sales: kpis.top_products_by_revenue(sales, 10),
        lambda sales: kpis.best_ranked_products(sales, 5),
        lambda sales: kpis.brand_concentration(sales, 5),
    ):
        assert records(build(stored)) == records(build(models.product_sales))
        assert "lineitem" not in physical(build(stored)) and "l_orderkey" not in physical(build(stored))


@pytest.mark.parametrize(
    "frame",
    [
        lambda m: m.top_products,
        lambda m: m.low_stock_analysis,
        lambda m: m.stock_top_products,
        lambda m: kpis.best_ranked_products(m.product_sales),
        lambda m: kpis.brand_concentration(m.product_sales),
        lambda m: kpis.revenue_concentration(m.customer_summary),
    ],
)
def test_rankings_read_the_lines_once(spark, stored, frame):
    """In what they write before and in the result together."""
    reads = []

    def scanned(df):
        return sum("list_price" in columns and "quantity" in columns for columns in scans(df))

    written = session.keep

    def counting(df, name="kept"):
        reads.append(scanned(df))
        return written(df, name)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ranking, "keep", counting)
        result = frame(Models(stored))
    assert sum(reads) + scanned(result) == 1


def test_sequences_meet_orders_before_these_hold_text(spark, stored, no_broadcast):
    """No shuffle by order carries names; the rows are those of the order history."""
    numbers = spark.createDataFrame([(1, 7), (2, 8)], "order_id bigint, _sequence int")
    models = Models(stored)
    rows = models.orders_with(numbers)
    assert records(rows) == [(*r, 7) for r in records(models.orders)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    for shuffle in re.findall(r"(?s)Exchange hashpartitioning\(order_id#.*?(?=Exchange|\Z)", plan):
        assert "full_name" not in shuffle and "store_name" not in shuffle
