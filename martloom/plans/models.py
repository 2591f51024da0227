"""All models over one set of sources, each built once and only when asked for."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import money
from martloom.functions.columns import days_between, is_on_time, year_month
from martloom.plans import analyses, intermediate, marts, staging
from martloom.session import keep
from martloom.sources.tables import with_tables


class Models:
    """The pipeline as lazy frames.

    Nothing runs until a frame is written or read, except that rankings write the distinct
    values they rank (see ``operators.ranking``).
    """

    def __init__(self, sources: Mapping[str, DataFrame], order_totals: DataFrame | None = None):
        """``order_totals`` are stored totals by order, used in place of the lines."""
        self.sources = sources
        self._stored_totals = order_totals
        self.facts_kept = False

    def for_orders(self, condition: Column) -> "Models":
        """The same pipeline over some orders only.

        Lines are limited to those orders before they are summed, so a small batch of
        orders costs one scan of the lines, not a shuffle of all of them.
        """
        orders = self.sources["orders"].where(condition)
        lines = self.sources["order_items"].join(orders.select("order_id"), "order_id", "left_semi")
        return Models(with_tables(self.sources, orders=orders, order_items=lines))

    def for_order_ids(self, ids: DataFrame) -> "Models":
        """The same pipeline over the orders whose order_id is in ``ids``."""
        orders = self.sources["orders"].join(ids, "order_id", "left_semi")
        lines = self.sources["order_items"].join(ids, "order_id", "left_semi")
        return Models(with_tables(self.sources, orders=orders, order_items=lines))

    def keep_order_facts(self, watch: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Write the order facts once, for runs that build several marts from them.

        They hold every order with its own columns; ``watch`` observes them.
        """
        facts = watch(self.order_facts) if watch else self.order_facts
        self.order_facts = keep(facts, "order-facts")
        self.facts_kept = True

    def keep_line_sums(self) -> None:
        """Write the lines' sums by order and product once, for runs that build several marts.

        Order totals, the category mart and product sales then read these, not the lines.
        """
        sums = keep(intermediate.line_sums(self.priced_lines, self.stg_orders), "line-sums")
        self.order_totals = intermediate.totals_of(sums)
        self.order_products = held = intermediate.products_of(sums)
        self.product_sales = marts.sold_products(held, self.product_dim)
        self.revenue_by_category = marts.categories_of(
            held, self.stg_products, self.stg_categories
        )

    # Staging

    @cached_property
    def stg_brands(self) -> DataFrame:
        return staging.stg_brands(self.sources["brands"])

    @cached_property
    def stg_categories(self) -> DataFrame:
        return staging.stg_categories(self.sources["categories"])

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.sources["customers"])

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.sources["order_items"])

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.sources["orders"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.sources["products"])

    @cached_property
    def stg_staffs(self) -> DataFrame:
        return staging.stg_staffs(self.sources["staffs"])

    @cached_property
    def stg_stocks(self) -> DataFrame:
        return staging.stg_stocks(self.sources["stocks"])

    @cached_property
    def stg_stores(self) -> DataFrame:
        return staging.stg_stores(self.sources["stores"])

    # Slim frames

    @cached_property
    def product_dim(self) -> DataFrame:
        return intermediate.product_dim(self.stg_products, self.stg_brands, self.stg_categories)

    @cached_property
    def priced_lines(self) -> DataFrame:
        return intermediate.priced_lines(self.stg_order_items)

    @cached_property
    def order_totals(self) -> DataFrame:
        if self._stored_totals is not None:
            return self._stored_totals
        return intermediate.order_totals(self.priced_lines)

    @cached_property
    def order_facts(self) -> DataFrame:
        return intermediate.order_facts(self.stg_orders, self.order_totals)

    @cached_property
    def order_facts_by_category(self) -> DataFrame:
        """Order facts with what each order holds of every category."""
        return intermediate.order_facts_by_category(
            self.stg_orders, self.priced_lines, self.stg_products
        )

    @cached_property
    def order_products(self) -> DataFrame:
        return intermediate.order_products(self.priced_lines, self.completed_orders)

    @cached_property
    def completed_orders(self) -> DataFrame:
        return intermediate.completed_orders(self.stg_orders)

    @cached_property
    def product_sales(self) -> DataFrame:
        return marts.product_sales(self.priced_lines, self.completed_orders, self.product_dim)

    @cached_property
    def order_measures(self) -> DataFrame:
        """The columns of the order history that need no dimension."""
        delay = days_between(F.col("shipped_date"), F.col("required_date"))
        return self.order_facts.select(
            "order_id",
            "order_status",
            "order_date",
            "shipped_date",
            "store_id",
            delay.alias("delivery_delay_days"),
            is_on_time(F.col("shipped_date"), delay).alias("is_on_time"),
            year_month(F.col("order_date")).alias("order_year_month"),
            money.dollars(F.col("revenue_cents")).alias("order_revenue"),
        )

    # Intermediate

    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return intermediate.int_orders_enriched(
            self.stg_orders, self.stg_customers, self.stg_stores, self.stg_staffs
        )

    @cached_property
    def int_order_items_enriched(self) -> DataFrame:
        return intermediate.int_order_items_enriched(self.stg_order_items, self.product_dim)

    @cached_property
    def int_orders_with_revenue(self) -> DataFrame:
        return intermediate.int_orders_with_revenue(
            self.order_facts, self.stg_customers, self.stg_stores, self.stg_staffs
        )

    # Marts

    @cached_property
    def orders(self) -> DataFrame:
        return marts.orders_mart(self.int_orders_with_revenue)

    def orders_with(self, numbers: DataFrame) -> DataFrame:
        """The orders that ``numbers`` has, with its other columns.

        They are joined to the order facts, which lie by order and hold no text yet.
        """
        more = tuple(c for c in numbers.columns if c != "order_id")
        facts = self.order_facts.join(numbers, "order_id")
        named = intermediate.int_orders_with_revenue(
            facts, self.stg_customers, self.stg_stores, self.stg_staffs, more
        )
        return marts.orders_mart(named, more)

    @cached_property
    def revenue_by_store(self) -> DataFrame:
        return marts.revenue_by_store(self.order_facts, self.stg_stores)

    @cached_property
    def revenue_by_category(self) -> DataFrame:
        return marts.revenue_by_category(
            self.priced_lines, self.completed_orders, self.stg_products, self.stg_categories
        )

    @cached_property
    def top_products(self) -> DataFrame:
        return marts.top_products(self.product_sales)

    @cached_property
    def customer_summary(self) -> DataFrame:
        return marts.customer_summary(self.order_facts, self.stg_customers)

    # Analyses

    @cached_property
    def late_deliveries_by_store(self) -> DataFrame:
        return analyses.late_deliveries_by_store(self.order_measures, self.stg_stores)

    @cached_property
    def low_stock_analysis(self) -> DataFrame:
        return analyses.low_stock_analysis(self.product_sales, self.stg_stocks, self.stg_stores)

    @cached_property
    def stock_top_products(self) -> DataFrame:
        return analyses.stock_top_products(self.product_sales, self.stg_stocks, self.stg_stores)
