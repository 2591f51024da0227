"""The five business marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import money
from martloom.functions.columns import COMPLETED, full_name, is_on_time, month_of, year_month
from martloom.operators.ranking import with_dense_rank


def orders_mart(orders_with_revenue: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Order history for reporting: delivery flag and month text, no email hash.

    Columns named in ``more`` are passed on.
    """
    return orders_with_revenue.select(
        "order_id",
        "order_status",
        "order_status_label",
        "order_date",
        "required_date",
        "shipped_date",
        "delivery_delay_days",
        is_on_time(F.col("shipped_date"), F.col("delivery_delay_days")).alias("is_on_time"),
        year_month(F.col("order_date")).alias("order_year_month"),
        "customer_id",
        "customer_first_name",
        "customer_last_name",
        "customer_full_name",
        "store_id",
        "store_name",
        "store_city",
        "store_state",
        "staff_id",
        "staff_first_name",
        "staff_last_name",
        "order_revenue",
        "order_units_sold",
        "order_line_count",
        *more,
    )


def revenue_by_store(facts: DataFrame, stores: DataFrame) -> DataFrame:
    """Monthly revenue per store. Completed orders without lines count in the average."""
    totals = (
        facts.where(F.col("order_status") == COMPLETED)
        .groupBy("store_id", month_of(F.col("order_date")).alias("order_month"))
        .agg(F.sum("revenue_cents").alias("cents"), F.count("*").alias("order_count"))
    )
    return store_months(totals, stores)


def store_months(totals: DataFrame, stores: DataFrame) -> DataFrame:
    """Cents and orders by store and month as the mart shows them."""
    return totals.join(stores, "store_id", "left").select(
        "store_id",
        "store_name",
        F.col("city").alias("store_city"),
        F.col("state").alias("store_state"),
        "order_month",
        money.dollars(F.col("cents")).alias("total_revenue"),
        "order_count",
        money.mean_dollars(F.col("cents"), F.col("order_count")).alias("avg_order_revenue"),
    )


def revenue_by_category(
    lines: DataFrame, completed: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """Monthly revenue per category.

    Lines are first summed per order, category and month. The order join has already
    placed each order in one partition, so this step moves no data, and it turns the
    distinct order count into a plain count of its rows.
    """
    per_order = (
        lines.join(products.select("product_id", "category_id"), "product_id", "left")
        .join(completed, "order_id")
        .groupBy("order_id", "category_id", month_of(F.col("order_date")).alias("order_month"))
        .agg(F.sum("line_cents").alias("cents"), F.sum("quantity").alias("units"))
    )
    return sold_categories(per_order, categories)


def sold_categories(per_order: DataFrame, categories: DataFrame) -> DataFrame:
    """The category mart from one row per completed order, category and month."""
    totals = per_order.groupBy("category_id", "order_month").agg(
        F.sum("cents").alias("cents"),
        F.sum("units").alias("units_sold"),
        F.count("order_id").alias("order_count"),
    )
    return category_months(totals, categories)


def categories_of(held: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """The category mart from what each completed order holds of every product."""
    per_order = (
        held.join(products.select("product_id", "category_id"), "product_id", "left")
        .groupBy("order_id", "category_id", "order_month")
        .agg(F.sum("cents").alias("cents"), F.sum("units").alias("units"))
    )
    return sold_categories(per_order, categories)


def category_months(totals: DataFrame, categories: DataFrame) -> DataFrame:
    """Cents, units and orders by category and month as the mart shows them."""
    return totals.join(categories, "category_id", "left").select(
        "category_id",
        "category_name",
        "order_month",
        money.dollars(F.col("cents")).alias("total_revenue"),
        "units_sold",
        "order_count",
    )


def product_sales(lines: DataFrame, completed: DataFrame, product_dim: DataFrame) -> DataFrame:
    """All-time revenue, units and orders per sold product, with cents for ranking."""
    per_order = (
        lines.join(completed.select("order_id"), "order_id", "left_semi")
        .groupBy("order_id", "product_id")
        .agg(F.sum("line_cents").alias("cents"), F.sum("quantity").alias("units"))
    )
    return sold_products(per_order, product_dim)


def sold_products(per_order: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Sold products from one row per completed order and product."""
    totals = per_order.groupBy("product_id").agg(
        F.sum("cents").alias("cents"),
        F.sum("units").alias("units_sold"),
        F.count("order_id").alias("order_count"),
    )
    return product_totals(totals, product_dim)


def product_totals(totals: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Cents, units and orders by product, named."""
    return totals.join(product_dim, "product_id", "left").select(
        "product_id",
        "product_name",
        "brand_name",
        "category_name",
        money.dollars(F.col("cents")).alias("total_revenue"),
        "units_sold",
        "order_count",
        "cents",
    )


def top_products(sales: DataFrame) -> DataFrame:
    """Sold products ranked by revenue without gaps."""
    return with_dense_rank(sales, "cents", "revenue_rank", descending=True).drop("cents")


def customer_summary(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Activity over all orders, and revenue over completed ones, per customer.

    One pass computes both. Rows are first reduced to one per customer and order, which
    the order join has already placed together, so distinct counts become plain counts.
    Orders without a customer form one row with no name and no revenue.
    """
    done = F.col("order_status") == COMPLETED
    per_order = facts.groupBy("customer_id", "order_id").agg(
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
        F.max(done).alias("done"),
        F.sum("revenue_cents").alias("cents"),
    )
    known = F.col("customer_id").isNotNull()
    finished = F.when(known & F.col("done"), F.col("order_id"))
    totals = per_order.groupBy("customer_id").agg(
        F.count("order_id").alias("total_order_count"),
        F.min("first_day").alias("first_order_date"),
        F.max("last_day").alias("last_order_date"),
        F.count(finished).alias("completed_order_count"),
        F.sum(F.when(known, F.col("cents"))).alias("cents"),
    )
    return customer_totals(totals, customers)


def customer_totals(totals: DataFrame, customers: DataFrame) -> DataFrame:
    """Activity and cents by customer as the mart shows them."""
    known = F.col("customer_id").isNotNull()
    name = full_name(F.col("first_name"), F.col("last_name"))
    names = customers.select("customer_id", "first_name", "last_name")
    return totals.join(names, "customer_id", "left").select(
        "customer_id",
        F.when(known, name).alias("customer_full_name"),
        "total_order_count",
        "first_order_date",
        "last_order_date",
        "completed_order_count",
        F.coalesce(money.dollars(F.col("cents")), F.lit(0.0)).alias("lifetime_value"),
        money.mean_dollars(F.col("cents"), F.col("completed_order_count")).alias("avg_basket"),
    )
