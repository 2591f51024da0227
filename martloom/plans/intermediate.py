"""Order-level and line-level facts with their dimensions.

The slim frames (``order_totals``, ``order_facts``, ``product_dim``) carry keys and cents
only. Marts aggregate these first and look up names afterwards, so that text never
travels through the large shuffles and dimension joins run on aggregated rows. That
equals joining first as long as dimension keys are unique, which the checks verify.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martloom.functions import money
from martloom.functions.columns import (
    COMPLETED,
    ORDER_STATUS,
    days_between,
    decode,
    full_name,
    month_of,
)


def product_dim(products: DataFrame, brands: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with brand and category names, joined on the small side."""
    return (
        products.join(brands, "brand_id", "left")
        .join(categories, "category_id", "left")
        .select(
            "product_id",
            "product_name",
            "model_year",
            F.col("list_price").alias("product_list_price"),
            "brand_id",
            "brand_name",
            "category_id",
            "category_name",
        )
    )


def priced_lines(items: DataFrame) -> DataFrame:
    """Order lines as keys, quantity and revenue in cents."""
    cents = money.line_cents(F.col("quantity"), F.col("list_price"), F.col("discount"))
    return items.select(
        "order_id", "item_id", "product_id", "quantity", money.wide(cents).alias("line_cents")
    )


def int_order_items_enriched(items: DataFrame, product_dim: DataFrame) -> DataFrame:
    """One row per order line, with its product. Lines of unknown products stay."""
    cents = money.line_cents(F.col("quantity"), F.col("list_price"), F.col("discount"))
    return items.join(product_dim, "product_id", "left").select(
        "order_id",
        "item_id",
        "quantity",
        "list_price",
        "discount",
        "product_id",
        "product_name",
        "model_year",
        "product_list_price",
        "brand_id",
        "brand_name",
        "category_id",
        "category_name",
        money.dollars(cents).alias("line_revenue"),
    )


def order_totals(lines: DataFrame) -> DataFrame:
    """Revenue, units and line count per order; partial sums precede the shuffle."""
    return lines.groupBy("order_id").agg(
        F.sum("line_cents").alias("revenue_cents"),
        F.sum("quantity").alias("units_sold"),
        F.count("item_id").alias("line_count"),
    )


def order_facts(orders: DataFrame, totals: DataFrame) -> DataFrame:
    """Orders with their totals. Only completed orders have revenue and units."""
    done = F.col("order_status") == COMPLETED
    return orders.join(totals, "order_id", "left").select(
        *orders.columns,
        F.when(done, F.col("revenue_cents")).alias("revenue_cents"),
        F.when(done, F.col("units_sold")).alias("units_sold"),
        "line_count",
    )


def order_facts_by_category(orders: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """Order facts with ``categories``: cents and units of every category in the order.

    An order holds each category once, however many lines it has. The join with the known
    orders places each order in one partition, so neither sum moves data, and an order's
    revenue follows from the same rows. A product that is listed twice counts in both its
    categories, but once in that revenue. Orders are to be unique, which their table checks.
    """
    first = F.row_number().over(W.partitionBy("product_id").orderBy("category_id")) == 1
    listed = products.select("product_id", "category_id", first.alias("first"))
    own = F.when(F.coalesce("first", F.lit(True)), F.col("line_cents"))
    held = (
        lines.join(listed, "product_id", "left")
        .join(orders.select("order_id"), "order_id")
        .groupBy("order_id", "category_id")
        .agg(
            F.sum("line_cents").alias("cents"),
            F.sum("quantity").alias("units"),
            F.sum(own).alias("own"),
        )
        .groupBy("order_id")
        .agg(
            F.sum("own").cast("decimal(28,0)").alias("revenue_cents"),
            F.collect_list(F.struct("category_id", "cents", "units")).alias("categories"),
        )
    )
    done = F.col("order_status") == COMPLETED
    return orders.join(held, "order_id", "left").select(
        "order_id",
        "customer_id",
        "store_id",
        "order_status",
        "order_date",
        F.when(done, F.col("revenue_cents")).alias("revenue_cents"),
        "categories",
    )


def line_sums(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of known orders summed by order and product, with the order's state and date.

    The order join places each order in one partition, so the sums move no data, and what
    is written in that order reduces again by order before any further shuffle.
    """
    known = orders.select("order_id", "order_status", "order_date")
    return (
        lines.join(known, "order_id")
        .groupBy("order_id", "product_id", "order_status", "order_date")
        .agg(
            F.sum("line_cents").alias("cents"),
            F.sum("quantity").alias("units"),
            F.count("item_id").alias("line_count"),
        )
    )


def totals_of(sums: DataFrame) -> DataFrame:
    """``order_totals`` from ``line_sums``."""
    return sums.groupBy("order_id").agg(
        F.sum("cents").alias("revenue_cents"),
        F.sum("units").alias("units_sold"),
        F.sum("line_count").alias("line_count"),
    )


def products_of(sums: DataFrame) -> DataFrame:
    """``order_products`` from ``line_sums``."""
    return sums.where(F.col("order_status") == COMPLETED).select(
        "order_id", "product_id", month_of(F.col("order_date")).alias("order_month"), "cents", "units"
    )


def order_products(lines: DataFrame, completed: DataFrame) -> DataFrame:
    """What each completed order holds of every product, with its month."""
    return (
        lines.join(completed, "order_id")
        .groupBy("order_id", "product_id", month_of(F.col("order_date")).alias("order_month"))
        .agg(F.sum("line_cents").alias("cents"), F.sum("quantity").alias("units"))
    )


def _with_dims(
    orders: DataFrame,
    customers: DataFrame,
    stores: DataFrame,
    staffs: DataFrame,
    measures: list,
) -> DataFrame:
    # No broadcast hints: the planner broadcasts a dimension when its measured size
    # allows it and shuffles it otherwise.
    buyers = customers.select(
        "customer_id",
        F.col("first_name").alias("customer_first_name"),
        F.col("last_name").alias("customer_last_name"),
        F.col("email_hash").alias("customer_email_hash"),
    )
    shops = stores.select(
        "store_id",
        "store_name",
        F.col("city").alias("store_city"),
        F.col("state").alias("store_state"),
    )
    sellers = staffs.select(
        "staff_id",
        F.col("first_name").alias("staff_first_name"),
        F.col("last_name").alias("staff_last_name"),
    )
    return (
        orders.join(buyers, "customer_id", "left")
        .join(shops, "store_id", "left")
        .join(sellers, "staff_id", "left")
        .select(
            "order_id",
            "order_status",
            decode(F.col("order_status"), ORDER_STATUS).alias("order_status_label"),
            "order_date",
            "required_date",
            "shipped_date",
            days_between(F.col("shipped_date"), F.col("required_date")).alias(
                "delivery_delay_days"
            ),
            "customer_id",
            "customer_first_name",
            "customer_last_name",
            full_name(F.col("customer_first_name"), F.col("customer_last_name")).alias(
                "customer_full_name"
            ),
            "customer_email_hash",
            "store_id",
            "store_name",
            "store_city",
            "store_state",
            "staff_id",
            "staff_first_name",
            "staff_last_name",
            *measures,
        )
    )


def int_orders_enriched(
    orders: DataFrame, customers: DataFrame, stores: DataFrame, staffs: DataFrame
) -> DataFrame:
    """One row per order, with customer, store and staff. Unresolved keys stay."""
    return _with_dims(orders, customers, stores, staffs, [])


def int_orders_with_revenue(
    facts: DataFrame,
    customers: DataFrame,
    stores: DataFrame,
    staffs: DataFrame,
    more: tuple[str, ...] = (),
) -> DataFrame:
    """``int_orders_enriched`` plus revenue, units and line count.

    Columns of the facts named in ``more`` are passed on.
    """
    measures = [
        money.dollars(F.col("revenue_cents")).alias("order_revenue"),
        F.col("units_sold").alias("order_units_sold"),
        F.col("line_count").alias("order_line_count"),
        *more,
    ]
    return _with_dims(facts, customers, stores, staffs, measures)


def completed_orders(orders: DataFrame) -> DataFrame:
    """Keys and dates of completed orders, without any dimension or revenue join."""
    return orders.where(F.col("order_status") == COMPLETED).select("order_id", "order_date")
