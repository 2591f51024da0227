"""Models on literal rows with literal expected results."""

import hashlib

from conftest import day, order, records
from pyspark.sql import functions as F

from martloom.plans.models import Models


def test_staging_types_and_protection(make_sources):
    models = Models(
        make_sources(
            staffs=[
                (1, 1, "NULL", "Di", "Fox", "p", "e", 1),
                (2, 1, "x", "Ed", None, "p", "e", 0),
                (3, 2, "3", "Flo", "Hay", "p", "e", 2),
            ],
            orders=[
                order(1, shipped="2016-01-12"),
                order(2),
                order(3, shipped=None),
                order(4, shipped="2016-13-01"),
            ],
            order_items=[(1, 1, 10, 2, 0.05, 0.1)],
        )
    )
    assert models.stg_customers.columns == ["customer_id", "first_name", "last_name", "email_hash"]
    hashes = dict(records(models.stg_customers, "customer_id", "email_hash"))
    assert hashes[1] == hashlib.sha256(b"ann@x.org").hexdigest() and hashes[2] is None
    staff = records(models.stg_staffs, "staff_id", "manager_id", "full_name", "active", "active_label")
    assert staff == [
        (1, None, "Di Fox", True, "Active"),
        (2, None, None, False, "Inactive"),
        (3, 3, "Flo Hay", True, "Unknown"),
    ]
    assert records(models.stg_orders, "order_id", "shipped_date") == [
        (1, day("2016-01-12")),
        (2, None),
        (3, None),
        (4, None),
    ]
    # The line amount is rounded once: 2 * 0.045 is 0.09, not 2 * 0.05.
    assert records(models.stg_order_items, "net_price", "line_revenue") == [(0.05, 0.09)]


def test_unresolved_keys_and_unknown_status_stay(make_sources):
    models = Models(
        make_sources(
            orders=[order(1, customer=99, store=99, staff=99, status=9)],
            order_items=[(1, 1, 99, 1, 10.0, 0.0)],
        )
    )
    row = models.int_orders_enriched.first()
    assert row.customer_full_name == " " and row.order_status_label is None
    assert (row.store_name, row.staff_first_name, row.customer_email_hash) == (None, None, None)
    line = models.int_order_items_enriched.first()
    assert (line.product_id, line.product_name, line.brand_id) == (99, None, None)
    assert line.line_revenue == 10.0


def test_revenue_only_for_completed_orders(make_sources):
    models = Models(
        make_sources(
            orders=[order(1), order(2, status=2), order(3)],
            order_items=[(1, 1, 10, 2, 10.0, 0.0), (1, 2, 11, 1, 5.0, 0.5), (2, 1, 10, 1, 9.0, 0.0)],
        )
    )
    got = records(
        models.int_orders_with_revenue,
        "order_id", "order_revenue", "order_units_sold", "order_line_count",
    )
    assert got == [(1, 22.5, 3, 2), (2, None, None, 1), (3, None, None, None)]


def test_orders_mart_columns_and_delivery(make_sources):
    models = Models(
        make_sources(
            orders=[
                order(1, required="2016-01-12", shipped="2016-01-11"),
                order(2, required="2016-01-12", shipped="2016-01-13"),
                order(3, required="2016-01-12"),
            ]
        )
    )
    got = records(models.orders, "order_id", "delivery_delay_days", "is_on_time", "order_year_month")
    assert got == [(1, -1, True, "2016-01"), (2, 1, False, "2016-01"), (3, None, None, "2016-01")]
    assert "customer_email_hash" not in models.orders.columns and len(models.orders.columns) == 23


def test_store_average_counts_orders_without_lines(make_sources):
    models = Models(
        make_sources(
            orders=[order(1), order(2), order(3, date="2016-02-01"), order(4, status=1)],
            order_items=[(1, 1, 10, 1, 10.01, 0.0)],
        )
    )
    got = records(
        models.revenue_by_store,
        "store_name", "store_city", "order_month", "total_revenue", "order_count",
        "avg_order_revenue",
    )
    assert got == [
        ("North", "Oslo", day("2016-01-01"), 10.01, 2, 5.01),
        ("North", "Oslo", day("2016-02-01"), None, 1, None),
    ]


def test_category_mart_counts_orders_once(make_sources):
    models = Models(
        make_sources(
            orders=[order(1), order(2), order(3, status=1)],
            order_items=[
                (1, 1, 11, 1, 10.0, 0.0),
                (1, 2, 12, 2, 1.0, 0.0),
                (2, 1, 11, 1, 10.0, 0.0),
                (2, 2, 99, 1, 3.0, 0.0),
                (3, 1, 11, 1, 10.0, 0.0),
            ],
        )
    )
    got = records(
        models.revenue_by_category, "category_name", "total_revenue", "units_sold", "order_count"
    )
    assert got == [("Trail", 22.0, 4, 2), (None, 3.0, 1, 1)]


def test_product_ranks_have_no_gaps(make_sources):
    models = Models(
        make_sources(
            orders=[order(1), order(2)],
            order_items=[
                (1, 1, 10, 1, 10.0, 0.0),
                (2, 1, 11, 2, 5.0, 0.0),
                (2, 2, 12, 1, 4.0, 0.0),
                (2, 3, 12, 1, 1.0, 0.0),
            ],
        )
    )
    got = records(models.top_products, "product_id", "total_revenue", "order_count", "revenue_rank")
    assert got == [(10, 10.0, 1, 1), (11, 10.0, 1, 1), (12, 5.0, 1, 2)]


def test_customer_summary(make_sources):
    models = Models(
        make_sources(
            orders=[
                order(1, customer=1, date="2016-01-05"),
                order(2, customer=1, date="2016-03-05"),
                order(3, customer=1, status=3, date="2016-04-05"),
                order(4, customer=2, status=2),
                order(5, customer=77),
                order(6, customer=None),
            ],
            order_items=[
                (1, 1, 10, 1, 10.0, 0.0),
                (2, 1, 10, 1, 0.01, 0.0),
                (4, 1, 10, 1, 50.0, 0.0),
                (6, 1, 10, 1, 50.0, 0.0),
            ],
        )
    )
    got = {r[0]: tuple(r[1:]) for r in models.customer_summary.collect()}
    jan, mid, apr = day("2016-01-05"), day("2016-01-10"), day("2016-04-05")
    assert got == {
        1: ("Ann Lee", 3, jan, apr, 2, 10.01, 5.01),
        2: ("Bob ", 1, mid, mid, 0, 0.0, None),
        77: (" ", 1, mid, mid, 1, 0.0, None),
        None: (None, 1, mid, mid, 0, 0.0, None),
    }


def test_late_deliveries(make_sources):
    models = Models(
        make_sources(
            orders=[
                order(1, required="2016-01-11", shipped="2016-01-12"),
                order(2, required="2016-01-11", shipped="2016-01-13"),
                order(3, required="2016-01-11", shipped="2016-01-11"),
                order(4, store=2, required="2016-01-11", shipped="2016-01-11"),
                order(5, store=2),
                order(6, store=2, status=1, required="2016-01-11", shipped="2016-02-11"),
            ]
        )
    )
    got = [tuple(r) for r in models.late_deliveries_by_store.collect()]
    assert got == [("North", 3, 1, 2, 66.7, 1.5, 2), ("South", 1, 1, 0, 0.0, None, None)]


def sold(*units):
    """One completed order per product, units as given, at a price of one."""
    ids = range(10, 10 + len(units))
    return {
        "orders": [order(i) for i in ids],
        "order_items": [(i, 1, i, u, 1.0, 0.0) for i, u in zip(ids, units)],
        "products": [(i, 1, 1, f"P{i}", 2016, 1.0) for i in ids],
    }


def test_low_stock_priorities_and_order(make_sources):
    tables = sold(10, 20, 30, 40, 50, 60)
    stocks = [(1, 10, 1), (1, 13, 5), (2, 14, 0), (1, 15, 6), (2, 15, 2), (1, 99, 0)]
    models = Models(make_sources(**tables, stocks=stocks))
    got = [
        (r.product_name, r.store_name, r.sales_percentile, r.stock_status, r.restock_priority)
        for r in models.low_stock_analysis.collect()
    ]
    assert got == [
        ("P15", "South", 1.0, "Low stock", "HIGH"),
        ("P14", "South", 0.8, "Out of stock", "HIGH"),
        ("P13", "North", 0.6, "Low stock", "MEDIUM"),
        ("P10", "North", 0.0, "Low stock", "LOW"),
    ]


def test_stock_of_top_products_keeps_ties_and_unstocked(make_sources):
    tables = sold(50, 50, 40, 30, 20)
    stocks = [(2, 10, 5), (1, 10, 0), (1, 12, 9), (1, 13, 1), (1, 14, 1)]
    models = Models(make_sources(**tables, stocks=stocks))
    got = [
        (r.revenue_rank, r.product_name, r.store_name, r.stock_quantity, r.stock_status)
        for r in models.stock_top_products.collect()
    ]
    # P11 has no stock row. Rank 1 is shared, so its rows may come in either order.
    assert sorted(got[:3], key=lambda r: (r[1], r[2] or "")) == [
        (1, "P10", "North", 0, "Out of stock"),
        (1, "P10", "South", 5, "Low stock"),
        (1, "P11", None, None, "In stock"),
    ]
    assert got[3:] == [
        (2, "P12", "North", 9, "In stock"),
        (3, "P13", "North", 1, "Low stock"),
    ]


def cents(df, column):
    return df.agg(F.sum(F.rint(F.col(column) * 100).cast("decimal(28,0)"))).first()[0]


def test_marts_reconcile(small):
    models = Models(small)
    total = cents(models.revenue_by_store, "total_revenue")
    assert total == cents(models.revenue_by_category, "total_revenue")
    assert total == cents(models.top_products, "total_revenue")
    assert total == cents(models.customer_summary, "lifetime_value")
    assert total == cents(models.orders, "order_revenue")
    completed = models.orders.where("order_status = 4").count()
    assert completed == models.revenue_by_store.agg(F.sum("order_count")).first()[0]
    assert completed == models.customer_summary.agg(F.sum("completed_order_count")).first()[0]


def test_joins_keep_the_grain(small):
    models = Models(small)
    assert models.int_orders_with_revenue.count() == models.stg_orders.count()
    assert models.int_order_items_enriched.count() == models.stg_order_items.count()


def test_order_subset_equals_filtered_result(small):
    models = Models(small)
    recent = F.col("order_date") >= "2000-01-01"
    assert records(models.for_orders(recent).orders) == records(models.orders.where(recent))
