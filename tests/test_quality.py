"""Every kind of check passes on sound data and reports exactly what was planted."""

import pytest
from conftest import order
from pyspark.sql import functions as F

from martloom.operators import quality
from martloom.plans import checks
from martloom.plans.models import Models

SOUND = {
    "customers": [(1, "Ann", "Lee", "1", "ann@x.org", "s", "c", "st", "z")],
    "orders": [order(1, required="2016-01-12", shipped="2016-01-11")],
    "order_items": [(1, 1, 10, 2, 10.0, 0.1), (1, 2, 11, 1, 5.0, 0.0)],
}


KINDS = {
    "not_null": lambda f: quality.not_null(f, checks.NOT_NULL),
    "unique": lambda f: quality.unique(f, checks.UNIQUE),
    "combination": lambda f: quality.unique_combination(f, checks.UNIQUE_COMBINATION),
    "relationships": lambda f: quality.relationships(f, checks.RELATIONSHIPS),
    "values": lambda f: quality.accepted_values(f, checks.ACCEPTED_VALUES),
    "rowcount": lambda f: quality.equal_rowcount(f, checks.EQUAL_ROWCOUNT),
    "rules": lambda f: quality.domain_rules(f, checks.domain_rules()),
}


def failures(sources, kind):
    """The checks of one kind that fail, over all models."""
    result = KINDS[kind](checks.ModelFrames(Models(sources)))
    rows = result.where(F.col("failures") > 0).collect()
    return {(r.model, r.test, r.column_name): r.failures for r in rows}


def test_sound_data_passes_every_check(make_sources):
    result = checks.run_all(checks.ModelFrames(Models(make_sources(**SOUND)))).cache()
    assert result.count() == 102 + 12 + 5 + 11 + 7 + 12 + 5
    assert result.where("status <> 'pass'").collect() == []


CASES = {
    "missing value": (
        "not_null",
        {"brands": [(1, "Acme"), (2, None)]},
        {("stg_brands", "not_null", "brand_name"): 1},
    ),
    "repeated key": (
        "unique",
        {"staffs": [(1, 1, "NULL", "Di", "Fox", "p", "e", 1)] * 3},
        {
            ("stg_staffs", "unique", "staff_id"): 1,
            ("int_orders_enriched", "unique", "order_id"): 1,
            ("int_orders_with_revenue", "unique", "order_id"): 1,
            ("orders", "unique", "order_id"): 1,
        },
    ),
    "multiplied rows": (
        "rowcount",
        {"staffs": [(1, 1, "NULL", "Di", "Fox", "p", "e", 1)] * 3},
        {("int_orders_enriched", "int_orders_no_row_explosion", "stg_orders"): 2},
    ),
    "repeated combination": (
        "combination",
        {"stocks": [(1, 10, 1), (1, 10, 2), (2, 10, 1)]},
        {("stg_stocks", "unique_combination_of_columns", "store_id,product_id"): 1},
    ),
    "missing parent": (
        "relationships",
        {"stocks": [(9, 10, 1), (9, 11, 1), (None, 12, 1)]},
        {("stg_stocks", "relationships", "store_id"): 2},
    ),
    "strange value": (
        "values",
        {"staffs": [(1, 1, "NULL", "Di", "Fox", "p", "e", 2), (2, 1, "1", "E", "G", "p", "e", 3)]},
        {("stg_staffs", "accepted_values", "active_label"): 1},
    ),
    "bad amounts": (
        "rules",
        {"order_items": [(1, 1, 10, 2, 10.0, 0.1), (1, 2, 11, 0, 5.0, 0.0), (1, 3, 11, 1, 5.0, 1.5)]},
        {
            ("stg_order_items", "order_items_positive_values",
             "order_id,item_id,quantity,list_price,discount"): 2,
        },
    ),
    "bad dates": (
        "rules",
        {"orders": [order(1, required="2016-01-09"), order(2, shipped="2016-01-01")]},
        {
            ("stg_orders", "orders_date_consistency",
             "order_id,order_date,required_date,shipped_date"): 2,
        },
    ),
    "negative stock": (
        "rules",
        {"stocks": [(1, 10, -1)]},
        {("stg_stocks", "stocks_non_negative_quantity", "store_id,product_id,quantity"): 1},
    ),
    "no revenue": (
        "rules",
        {"order_items": [(1, 1, 10, 2, 10.0, 1.0)]},
        {("revenue_by_store", "revenue_by_store_positive_revenue",
          "store_id,order_month,total_revenue"): 1},
    ),
}


@pytest.mark.parametrize("case", CASES)
def test_planted_violation(make_sources, case):
    kind, changed, want = CASES[case]
    assert failures(make_sources(**{**SOUND, **changed}), kind) == want


def test_negative_lifetime_value(make_sources):
    sources = make_sources(**{**SOUND, "order_items": [(1, 1, 10, -2, 10.0, 0.0)]})
    found = failures(sources, "rules")
    name = "customer_summary_lifetime_value_non_negative"
    assert found[("customer_summary", name, "customer_id,lifetime_value")] == 1


def test_lost_rows_are_counted(make_sources):
    models = Models(make_sources(**SOUND))
    frames = checks.ModelFrames(models, {"orders": models.orders.where("order_id > 1")})
    rows = quality.equal_rowcount(frames, checks.EQUAL_ROWCOUNT).where("failures > 0").collect()
    assert [(r.model, r.column_name, r.failures) for r in rows] == [
        ("orders", "int_orders_with_revenue", 1)
    ]


def test_failing_rows_are_shown(make_sources):
    models = Models(make_sources(**{**SOUND, "stocks": [(1, 10, -4), (1, 11, 4)]}))
    rule = next(r for r in checks.domain_rules() if r.model == "stg_stocks")
    rows = quality.failing_rows(checks.ModelFrames(models), rule).collect()
    assert [tuple(r) for r in rows] == [(1, 10, -4)]


def test_failing_values_show_planted_violations(spark):
    orders = spark.createDataFrame(
        [(1, 4, 7), (1, 9, 7), (2, None, 8), (None, 9, None)], "id long, status long, parent long"
    )
    frames = {"orders": orders, "parents": spark.createDataFrame([(7,), (7,)], "id long")}
    wanted = (
        quality.Failing("not_null", "orders", "status"),
        quality.Failing("unique", "orders", "id"),
        quality.Failing("accepted_values", "orders", "status", accepted=(4,)),
        quality.Failing("relationships", "orders", "parent", parent=("parents", "id")),
    )
    got = {(r.test, r.value, r.rows) for r in quality.failing_values(frames, wanted).collect()}
    assert got == {
        ("not_null", None, 1),
        ("unique", "1", 2),
        ("accepted_values", "9", 2),
        ("relationships", "8", 1),
    }
    assert quality.orphan_rows(orders, "parent", frames["parents"], "id").first()["id"] == 2
    assert quality.repeated_values(orders, "id", "status").count() == 0
