"""Building the stored tables, incrementally where that applies, and checking them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.tables import MonthlyTable, SnapshotTable
from martloom.plans import checks
from martloom.plans.descriptions import RELATIONS, described
from martloom.plans.models import Models
from martloom.session import temporary_tables

STAGING_VIEWS = (
    "stg_brands",
    "stg_categories",
    "stg_customers",
    "stg_order_items",
    "stg_orders",
    "stg_products",
    "stg_staffs",
    "stg_stocks",
    "stg_stores",
)
INTERMEDIATE_VIEWS = (
    "int_orders_enriched",
    "int_order_items_enriched",
    "int_orders_with_revenue",
)
TABLES = ("revenue_by_store", "revenue_by_category", "top_products", "customer_summary")
LOOKBACK_DAYS = 7


def mart_path(base: str, env: str, name: str) -> str:
    """Where a mart lives: one folder per environment and layer."""
    return f"{base.rstrip('/')}/{env}/mart/{name}"


def view_name(env: str, name: str) -> str:
    """Environment, layer and model, so that no environment hides another's views."""
    layer = "staging" if name in STAGING_VIEWS else "intermediate"
    return f"{env}_{layer}_{name}"


def register_views(models: Models, env: str = "dev") -> None:
    """Offer the staging and intermediate models to SQL as views."""
    for name in (*STAGING_VIEWS, *INTERMEDIATE_VIEWS):
        described(name, getattr(models, name)).createOrReplaceTempView(view_name(env, name))


def refresh_orders(
    models: Models,
    table: MonthlyTable,
    full_refresh: bool = False,
    watch: checks.BuildChecks | None = None,
) -> None:
    """Bring the order history up to date.

    The first run and a full refresh write everything. Later runs take the orders from
    seven days before the newest stored one: older changes stay out until the next full
    refresh, as do orders without a date. A table that exists but is empty has no newest
    order, so such a run loads nothing.
    """
    watched = {"watch": watch["orders"]} if watch else {}
    if full_refresh or not table.exists():
        if watch:
            watch.all_orders_written()
        table.replace(described("orders", models.orders), **watched)
        return
    cutoff = table.cutoff(LOOKBACK_DAYS)
    recent = F.lit(False) if cutoff is None else F.col("order_date") >= F.lit(cutoff)
    # Kept facts hold the totals already; otherwise only the batch's lines are summed.
    batch = models.orders.where(recent) if models.facts_kept else models.for_orders(recent).orders
    table.merge(described("orders", batch), **watched)


def build(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    base: str,
    env: str = "dev",
    full_refresh: bool = False,
    watch: checks.BuildChecks | None = None,
) -> dict[str, SnapshotTable]:
    """Write all marts under ``base/env`` and return them by name.

    With ``watch``, checks on rows are counted while the build writes them.
    """
    register_views(Models(sources), env)
    orders = MonthlyTable(spark, mart_path(base, env, "orders"), comment=RELATIONS["orders"])
    tables = {
        name: SnapshotTable(spark, mart_path(base, env, name), RELATIONS[name]) for name in TABLES
    }
    with temporary_tables(spark):
        models = Models(sources)
        if watch:
            models.stg_order_items = watch["stg_order_items"](models.stg_order_items)
        # Two marts and the order totals follow from the lines' sums, which are written once,
        # as are the facts of all orders, which three marts read.
        models.keep_line_sums()
        models.keep_order_facts(**({"watch": watch["stg_orders"]} if watch else {}))
        refresh_orders(models, orders, full_refresh, watch)
        for name, table in tables.items():
            mart = described(name, getattr(models, name))
            table.replace(mart, **({"watch": watch[name]} if watch else {}))
    return {"orders": orders, **tables}


def validate(sources: Mapping[str, DataFrame], tables: dict[str, SnapshotTable]) -> DataFrame:
    """Run every check over the views and the stored marts."""
    stored = {name: table.read() for name, table in tables.items()}
    return checks.run_all(checks.ModelFrames(Models(sources), stored))
