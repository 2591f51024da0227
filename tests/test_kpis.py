"""Business figures on literal mart rows."""

import pytest
from conftest import day, order, records

import __spark_entry__ as entry
from martloom.plans import kpis
from martloom.plans.models import Models


@pytest.fixture(scope="module")
def by_store(spark):
    rows = [
        (1, "North", day("2016-01-01"), 100.0, 2),
        (1, "North", day("2016-02-01"), 50.5, 1),
        (1, "North", day("2017-01-01"), 75.25, 1),
        (2, "South", day("2016-01-01"), 24.25, 1),
        (2, "South", day("2017-03-01"), 48.5, 3),
        (2, "South", day("2017-04-01"), None, 1),
    ]
    return spark.createDataFrame(
        rows, "store_id bigint, store_name string, order_month date, total_revenue double,"
        " order_count bigint",
    )


@pytest.fixture(scope="module")
def summary(spark):
    rows = [(i, f"C{i}", float(v), v / 2 if v else None) for i, v in enumerate([400, 300, 200, 100, 0])]
    schema = "customer_id bigint, customer_full_name string, lifetime_value double, avg_basket double"
    return spark.createDataFrame(rows, schema)


def test_total_revenue_and_its_filters(by_store):
    assert records(kpis.total_revenue(by_store)) == [(298.5, 9)]
    assert records(kpis.total_revenue(by_store, store_id=2)) == [(72.75, 5)]
    assert records(kpis.total_revenue(by_store, start="2016-02-01", end=day("2017-01-31"))) == [
        (125.75, 2)
    ]


def test_store_share_and_growth(by_store):
    assert records(kpis.store_share(by_store)) == [
        (1, "North", 225.75, 75.6, 4),
        (2, "South", 72.75, 24.4, 5),
    ]
    assert records(kpis.store_year_growth(by_store)) == [
        (1, "North", 2016, 150.5, None),
        (1, "North", 2017, 75.25, -50.0),
        (2, "South", 2016, 24.25, None),
        (2, "South", 2017, 48.5, 100.0),
    ]
    months = [r.order_month for r in kpis.monthly_revenue_by_store(by_store).collect()]
    assert len(months) == 6 and months[:3] == sorted(months[:3])


def test_category_figures(spark):
    rows = [(1, "Road", 10.0, 3), (1, "Road", 0.0, 1), (2, "Trail", 30.0, 4)]
    df = spark.createDataFrame(
        rows, "category_id bigint, category_name string, total_revenue double, units_sold bigint"
    )
    assert records(kpis.revenue_share_by_category(df)) == [
        (1, "Road", 10.0, 25.0),
        (2, "Trail", 30.0, 75.0),
    ]
    assert [tuple(r)[3:] for r in kpis.category_unit_value(df).collect()] == [(4, 7.5), (4, 2.5)]


def test_order_figures(make_sources):
    models = Models(
        make_sources(
            orders=[
                order(1, date="2016-11-01", required="2016-11-02", shipped="2016-11-04"),
                order(2, date="2016-12-01", required="2016-12-02", shipped="2016-12-02"),
                order(3, date="2017-01-01", required="2017-01-02", shipped="2017-01-03"),
                order(4, date="2017-01-05", status=1),
            ],
            order_items=[(1, 1, 10, 1, 60.0, 0.0), (2, 1, 10, 1, 40.0, 0.0), (3, 1, 10, 1, 25.01, 0.0)],
        )
    )
    orders = models.order_measures
    assert records(kpis.basket_per_order(orders)) == [(3, 41.67)]
    assert records(kpis.delivery_performance(orders)) == [(3, 1, 2, 33.3, 66.7, 1.5)]
    assert records(kpis.lead_time(orders)) == [(3, 2.0)]
    assert records(kpis.yearly_growth(orders)) == [(2016, 100.0, 2, None), (2017, 25.01, 1, -75.0)]
    assert records(kpis.annual_run_rate(orders)) == [
        (2016, 2, 100.0, 600.0),
        (2017, 1, 25.01, 300.12),
    ]
    trend = [tuple(r) for r in kpis.monthly_order_trend(orders).collect()]
    assert trend == [("2016-11", 1, 1, 60.0), ("2016-12", 1, 1, 40.0), ("2017-01", 2, 1, 25.01)]


def test_growth_needs_the_calendar_year_before(spark, make_sources):
    """A year after a gap has nothing to grow from."""
    rows = [(1, "North", day(f"{year}-02-01"), amount, 1) for year, amount in
            ((2014, 10.0), (2016, 20.0), (2017, 30.0))]
    by_store = spark.createDataFrame(
        rows, "store_id bigint, store_name string, order_month date, total_revenue double,"
        " order_count bigint",
    )
    growth = [r.growth_pct for r in kpis.store_year_growth(by_store).orderBy("order_year").collect()]
    assert growth == [None, None, 50.0]
    orders = [order(i, date=f"{year}-03-01") for i, year in enumerate((2014, 2016, 2017))]
    lines = [(i, 1, 10, 1, amount, 0.0) for i, amount in enumerate((10.0, 20.0, 30.0))]
    models = Models(make_sources(orders=orders, order_items=lines))
    assert records(kpis.yearly_growth(models.order_measures), "order_year", "growth_pct") == [
        (2014, None), (2016, None), (2017, 50.0),
    ]


def test_customer_figures(summary):
    assert records(kpis.basket_per_customer(summary)) == [(4, 125.0)]
    assert [r.customer_id for r in kpis.top_customers(summary, 2).collect()] == [0, 1]
    assert records(kpis.revenue_concentration(summary)) == [
        (1, 1, 400.0, 40.0),
        (10, 1, 0.0, 0.0),
        (3, 1, 300.0, 30.0),
        (6, 1, 200.0, 20.0),
        (8, 1, 100.0, 10.0),
    ]


def test_best_products_and_brands(spark):
    rows = [(i, f"P{i}", b, "Road", float(c), c, 1, c * 100) for i, b, c in
            [(1, "Acme", 50), (2, "Zeta", 40), (3, "Acme", 40), (4, "Zeta", 10)]]
    sales = spark.createDataFrame(
        rows, "product_id bigint, product_name string, brand_name string, category_name string,"
        " total_revenue double, units_sold bigint, order_count bigint, cents bigint",
    )
    assert [r.product_id for r in kpis.top_products_by_revenue(sales, 3).collect()] == [1, 2, 3]
    assert records(kpis.best_ranked_products(sales, 2), "revenue_rank", "product_id") == [
        (1, 1), (2, 2), (2, 3),
    ]
    assert records(kpis.brand_concentration(sales, 2)) == [
        ("Acme", 2, 90.0, 69.2),
        ("Zeta", 1, 40.0, 30.8),
    ]


def test_stock_alerts(make_sources):
    models = Models(make_sources())
    got = records(kpis.stock_alerts(models.stg_stocks, models.stg_stores, models.stg_products))
    assert got == [
        (1, "North", 10, "Alpha", 0, "Out of stock"),
        (2, "South", 10, "Alpha", 5, "Low stock"),
    ]


def test_published_figures_name_no_customer(small):
    internal = {"kpi_customer_ltv": "customer_ltv", "kpi_top_20_customers": "top_customers"}
    assert set(internal.values()) == kpis.INTERNAL
    models = Models(small)
    named = {"customer_id", "customer_full_name", "customer_first_name", "customer_last_name"}
    for name, kpi in entry.KPI_QUERIES.items():
        public = not named & set(kpi(models).columns)
        assert public == (name not in internal), name
