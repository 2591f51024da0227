"""Business figures read off the marts.

Every function takes mart frames. Averages and shares round half away from zero. A
share needs the grand total beside each row: it is a scalar subquery over the grouped
rows, so no window spans the table and no job runs before the result is asked for.

Products are read from the product frame or from the stored ranking, which knows the
rank of every product and needs no look at the order lines.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martloom.functions import money
from martloom.functions.columns import COMPLETED, LOW_STOCK, days_between, stock_status
from martloom.operators.ranking import best_by_revenue, with_percent_rank

# Queries whose rows name a customer stay internal; all others may be published.
INTERNAL = frozenset({"customer_ltv", "top_customers"})


def _sum_dollars(column: str):
    return F.sum(money.cents_of(F.col(column)))


def _year(column: str):
    return F.year(column).cast("bigint")


def _with_share(grouped: DataFrame, cents: str = "cents") -> DataFrame:
    total = grouped.agg(F.sum(cents)).scalar()
    return grouped.withColumn("revenue_share_pct", money.percent(F.col(cents), total))


def total_revenue(
    by_store: DataFrame,
    store_id: int | None = None,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Revenue and orders, optionally of one store and of months in [start, end]."""
    rows = by_store
    if store_id is not None:
        rows = rows.where(F.col("store_id") == store_id)
    if start is not None:
        rows = rows.where(F.col("order_month") >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(F.col("order_month") <= F.lit(end).cast("date"))
    return rows.agg(
        money.dollars(_sum_dollars("total_revenue")).alias("total_revenue"),
        F.sum("order_count").alias("order_count"),
    )


def monthly_revenue_by_store(by_store: DataFrame) -> DataFrame:
    return by_store.select("store_id", "store_name", "order_month", "total_revenue").orderBy(
        "store_id", "order_month"
    )


def top_products_by_revenue(sales: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best sellers. Equal revenue is decided by product id."""
    return (
        sales.orderBy(F.desc("total_revenue"), "product_id")
        .limit(n)
        .select("product_id", "product_name", "brand_name", "category_name", "total_revenue")
    )


def revenue_share_by_category(by_category: DataFrame) -> DataFrame:
    grouped = by_category.groupBy("category_id", "category_name").agg(
        _sum_dollars("total_revenue").alias("cents")
    )
    return _with_share(grouped).select(
        "category_id",
        "category_name",
        money.dollars(F.col("cents")).alias("total_revenue"),
        "revenue_share_pct",
    )


def basket_per_order(orders: DataFrame) -> DataFrame:
    """Average revenue of a completed order."""
    done = F.col("order_status") == COMPLETED
    return orders.where(done).agg(
        F.count("order_id").alias("completed_orders"),
        money.mean_dollars(_sum_dollars("order_revenue"), F.count("order_id")).alias(
            "avg_basket_per_order"
        ),
    )


def basket_per_customer(customers: DataFrame) -> DataFrame:
    """Mean of the customers' average baskets."""
    return customers.agg(
        F.count("avg_basket").alias("buying_customers"),
        money.mean_dollars(_sum_dollars("avg_basket"), F.count("avg_basket")).alias(
            "avg_basket_per_customer"
        ),
    )


def delivery_performance(orders: DataFrame) -> DataFrame:
    """On-time and late counts and rates of shipped, completed orders.

    As in the analysis by store, an order whose delay is unknown counts as on time.
    """
    late = F.coalesce(F.col("delivery_delay_days") > 0, F.lit(False))
    late_days = F.when(late, F.col("delivery_delay_days"))
    shipped = (F.col("order_status") == COMPLETED) & F.col("shipped_date").isNotNull()
    counts = orders.where(shipped).agg(
        F.count("*").alias("shipped_orders"),
        F.count_if(~late).alias("on_time_orders"),
        F.count_if(late).alias("late_orders"),
        F.sum(late_days).alias("late_days"),
    )
    return counts.select(
        "shipped_orders",
        "on_time_orders",
        "late_orders",
        money.percent(F.col("on_time_orders"), F.col("shipped_orders")).alias("on_time_rate_pct"),
        money.percent(F.col("late_orders"), F.col("shipped_orders")).alias("late_rate_pct"),
        money.ratio(F.col("late_days"), F.col("late_orders")).alias("avg_delay_days_when_late"),
    )


def customer_ltv(customers: DataFrame) -> DataFrame:
    """Lifetime value per customer (internal)."""
    return customers.select("customer_id", "customer_full_name", "lifetime_value")


def monthly_order_trend(orders: DataFrame) -> DataFrame:
    """Orders of any status per month, and the completed ones with their revenue."""
    done = F.col("order_status") == COMPLETED
    return (
        orders.groupBy("order_year_month")
        .agg(
            F.count("order_id").alias("order_count"),
            F.count_if(done).alias("completed_order_count"),
            money.dollars(_sum_dollars("order_revenue")).alias("total_revenue"),
        )
        .orderBy("order_year_month")
    )


def store_share(by_store: DataFrame) -> DataFrame:
    grouped = by_store.groupBy("store_id", "store_name").agg(
        _sum_dollars("total_revenue").alias("cents"), F.sum("order_count").alias("order_count")
    )
    return _with_share(grouped).select(
        "store_id",
        "store_name",
        money.dollars(F.col("cents")).alias("total_revenue"),
        "revenue_share_pct",
        "order_count",
    )


def _growth(cents: str, window):
    """Growth over the calendar year before; none where that year has no row."""
    last = F.lag("order_year").over(window)
    before = F.when(last == F.col("order_year") - 1, F.lag(cents).over(window))
    return money.percent(F.col(cents) - before, before)


def store_year_growth(by_store: DataFrame) -> DataFrame:
    """Revenue per store and year, and growth over the store's year before."""
    grouped = by_store.groupBy("store_id", "store_name", _year("order_month").alias("order_year")).agg(
        _sum_dollars("total_revenue").alias("cents")
    )
    years = W.partitionBy("store_id").orderBy("order_year")
    return grouped.select(
        "store_id",
        "store_name",
        "order_year",
        money.dollars(F.col("cents")).alias("total_revenue"),
        _growth("cents", years).alias("growth_pct"),
    )


def category_unit_value(by_category: DataFrame) -> DataFrame:
    """Revenue, units and revenue per unit per category, the most valuable unit first."""
    grouped = by_category.groupBy("category_id", "category_name").agg(
        _sum_dollars("total_revenue").alias("cents"), F.sum("units_sold").alias("units_sold")
    )
    return grouped.select(
        "category_id",
        "category_name",
        money.dollars(F.col("cents")).alias("total_revenue"),
        "units_sold",
        money.mean_dollars(F.col("cents"), F.col("units_sold")).alias("revenue_per_unit"),
    ).orderBy(F.desc("revenue_per_unit"))


def best_ranked_products(sales: DataFrame, ranks: int = 5) -> DataFrame:
    """Products on the first ``ranks`` revenue ranks, ties included."""
    return best_by_revenue(sales, ranks).select(
        "revenue_rank",
        "product_id",
        "product_name",
        "brand_name",
        "category_name",
        "total_revenue",
        "units_sold",
    )


def brand_concentration(sales: DataFrame, ranks: int = 5) -> DataFrame:
    """How the first ``ranks`` revenue ranks spread over brands."""
    grouped = (
        best_by_revenue(sales, ranks)
        .groupBy("brand_name")
        .agg(F.count("*").alias("product_count"), _sum_dollars("total_revenue").alias("cents"))
    )
    return _with_share(grouped).select(
        "brand_name",
        "product_count",
        money.dollars(F.col("cents")).alias("total_revenue"),
        "revenue_share_pct",
    )


def _by_year(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("order_status") == COMPLETED)
        .groupBy(_year("order_date").alias("order_year"))
        .agg(
            _sum_dollars("order_revenue").alias("cents"),
            F.count("order_id").alias("order_count"),
            F.count_distinct(F.month("order_date")).alias("months_present"),
        )
    )


def yearly_growth(orders: DataFrame) -> DataFrame:
    """Completed revenue and orders per year, and growth over the year before."""
    # One row per calendar year reaches this window.
    years = W.orderBy("order_year")
    return _by_year(orders).select(
        "order_year",
        money.dollars(F.col("cents")).alias("total_revenue"),
        "order_count",
        _growth("cents", years).alias("growth_pct"),
    )


def annual_run_rate(orders: DataFrame) -> DataFrame:
    """Each year's revenue scaled from the months it has to twelve."""
    return _by_year(orders).select(
        "order_year",
        "months_present",
        money.dollars(F.col("cents")).alias("total_revenue"),
        money.mean_dollars(F.col("cents") * 12, F.col("months_present")).alias("annual_run_rate"),
    )


def stock_alerts(stocks: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Products that are out of or low in stock, sold or not."""
    quantity = F.col("quantity")
    return (
        stocks.where(quantity <= LOW_STOCK)
        .join(products.select("product_id", "product_name"), "product_id", "left")
        .join(stores.select("store_id", "store_name"), "store_id", "left")
        .select(
            "store_id",
            "store_name",
            "product_id",
            "product_name",
            quantity.alias("stock_quantity"),
            stock_status(quantity, "In stock").alias("stock_status"),
        )
    )


def top_customers(customers: DataFrame, n: int = 20) -> DataFrame:
    """Customers with the highest lifetime value (internal). Ties go by customer id."""
    return customers.orderBy(F.desc("lifetime_value"), "customer_id").limit(n)


def revenue_concentration(customers: DataFrame) -> DataFrame:
    """Share of revenue per tenth of the customers, best customers first, no names."""
    ranked = with_percent_rank(
        customers.select("lifetime_value"), "lifetime_value", "position", descending=True
    )
    tenth = F.least(F.floor(F.col("position") * 10), F.lit(9)) + 1
    grouped = ranked.groupBy(tenth.cast("bigint").alias("customer_tenth")).agg(
        F.count("*").alias("customer_count"), _sum_dollars("lifetime_value").alias("cents")
    )
    return _with_share(grouped).select(
        "customer_tenth",
        "customer_count",
        money.dollars(F.col("cents")).alias("total_revenue"),
        "revenue_share_pct",
    )


def lead_time(orders: DataFrame) -> DataFrame:
    """Average days from order to shipment over completed, shipped orders."""
    shipped = orders.where(
        (F.col("order_status") == COMPLETED) & F.col("shipped_date").isNotNull()
    )
    days = days_between(F.col("shipped_date"), F.col("order_date"))
    return shipped.agg(
        F.count("*").alias("shipped_orders"),
        money.ratio(F.sum(days), F.count(days)).alias("avg_lead_time_days"),
    )
