"""Delivery and stock analyses.

Each sorts by the order it is read in and then by name, so that rows which tie are not
all sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import money
from martloom.functions.columns import COMPLETED, LOW_STOCK, restock_priority, stock_status
from martloom.operators.ranking import best_by_revenue, with_percent_rank


def late_deliveries_by_store(orders: DataFrame, stores: DataFrame) -> DataFrame:
    """Delivery performance of completed, shipped orders per store, worst first.

    ``orders`` needs store_id, order_status, shipped_date and delivery_delay_days.
    An order whose delay is unknown counts as on time.
    """
    late = F.coalesce(F.col("delivery_delay_days") > 0, F.lit(False))
    late_days = F.when(late, F.col("delivery_delay_days"))
    totals = (
        orders.where((F.col("order_status") == COMPLETED) & F.col("shipped_date").isNotNull())
        .groupBy("store_id")
        .agg(
            F.count("order_id").alias("total_completed_orders"),
            F.count_if(~late).alias("on_time_orders"),
            F.count_if(late).alias("late_orders"),
            F.sum(late_days).alias("late_days"),
            F.max(late_days).alias("max_delay_days"),
        )
    )
    return (
        totals.join(stores.select("store_id", "store_name"), "store_id", "left")
        .select(
            "store_name",
            "total_completed_orders",
            "on_time_orders",
            "late_orders",
            money.percent(F.col("late_orders"), F.col("total_completed_orders")).alias(
                "late_delivery_rate_pct"
            ),
            money.ratio(F.col("late_days"), F.col("late_orders")).alias("avg_delay_days_when_late"),
            "max_delay_days",
        )
        .orderBy(F.desc("late_delivery_rate_pct"), "store_name")
    )


def low_stock_analysis(sales: DataFrame, stocks: DataFrame, stores: DataFrame) -> DataFrame:
    """Sold products that are out of or low in stock, the best sellers first.

    ``sales`` has one row per sold product. The stock filter reaches the stock scan, so
    only the rows that need attention are joined.
    """
    ranked = with_percent_rank(
        sales.select(
            "product_id",
            "product_name",
            "brand_name",
            "category_name",
            "units_sold",
            "total_revenue",
        ),
        "units_sold",
        "sales_percentile",
        stored="revenue_rank" in sales.columns,
    )
    quantity = F.col("quantity")
    names = stores.select("store_id", "store_name")
    urgency = F.when(F.col("restock_priority") == "HIGH", 1).when(
        F.col("restock_priority") == "MEDIUM", 2
    )
    return (
        ranked.join(stocks.where(quantity <= LOW_STOCK), "product_id")
        .join(names, "store_id", "left")
        .select(
            "product_name",
            "brand_name",
            "category_name",
            "units_sold",
            "total_revenue",
            "sales_percentile",
            "store_name",
            quantity.alias("stock_quantity"),
            stock_status(quantity, "OK").alias("stock_status"),
            restock_priority(quantity, F.col("sales_percentile")).alias("restock_priority"),
        )
        .orderBy(
            F.coalesce(urgency, F.lit(3)), F.desc("total_revenue"), "product_name", "store_name"
        )
    )


def stock_top_products(
    sales: DataFrame, stocks: DataFrame, stores: DataFrame, top: int = 3
) -> DataFrame:
    """Stock per store of the products on the first ``top`` revenue ranks.

    ``sales`` is a frame of sold products or the stored ranking of them.
    """
    best = best_by_revenue(sales, top)
    quantity = F.col("quantity")
    return (
        best.join(stocks, "product_id", "left")
        .join(stores.select("store_id", "store_name"), "store_id", "left")
        .select(
            "revenue_rank",
            "product_name",
            "brand_name",
            "category_name",
            "total_revenue",
            "units_sold",
            "store_name",
            quantity.alias("stock_quantity"),
            stock_status(quantity, "In stock").alias("stock_status"),
        )
        .orderBy("revenue_rank", "store_name", "product_name")
    )
