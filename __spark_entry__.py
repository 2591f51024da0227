"""The registered queries and their expected results.

``queries()`` maps a name to a function of (spark, folder with the test tables);
``oracle_sql()`` has the same result as SQL for each of them.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402
from martloom.operators import quality, ranking  # noqa: E402
from martloom.operators.tables import MonthlyTable  # noqa: E402
from martloom.plans import checks, kpis, pipeline  # noqa: E402
from martloom.plans.incremental import KeptMarts  # noqa: E402
from martloom.plans.models import Models  # noqa: E402
from martloom.session import keep, local_trial, scratch_path  # noqa: E402
from martloom.sources import from_testdata, with_tables  # noqa: E402
from martloom.sources.testdata import SCHEMAS, orders_source  # noqa: E402
from martloom.streaming.line_feed import order_totals_table, start_line_feed  # noqa: E402
from martloom.streaming.order_feed import start_order_feed  # noqa: E402

# The corpus operators may be absent; everything else works without them.
try:
    import corpus_pipeline
    from martloom.llm import registry as corpus
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "martloom.llm"):
        raise
    corpus = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

MODEL_QUERIES = (
    *pipeline.STAGING_VIEWS,
    *pipeline.INTERMEDIATE_VIEWS,
    "orders",
    *pipeline.TABLES,
    "late_deliveries_by_store",
    "low_stock_analysis",
    "stock_top_products",
)

KPI_QUERIES: dict[str, Callable[[Models], DataFrame]] = {
    "kpi_total_revenue": lambda m: kpis.total_revenue(m.revenue_by_store),
    "kpi_total_revenue_store_period": lambda m: kpis.total_revenue(
        m.revenue_by_store, 1, start="1996-01-01", end="1997-12-01"
    ),
    "kpi_monthly_revenue_by_store": lambda m: kpis.monthly_revenue_by_store(m.revenue_by_store),
    "kpi_top_10_products": lambda m: kpis.top_products_by_revenue(m.product_sales, 10),
    "kpi_revenue_share_by_category": lambda m: kpis.revenue_share_by_category(
        m.revenue_by_category
    ),
    "kpi_basket_per_order": lambda m: kpis.basket_per_order(m.order_measures),
    "kpi_basket_per_customer": lambda m: kpis.basket_per_customer(m.customer_summary),
    "kpi_delivery_performance": lambda m: kpis.delivery_performance(m.order_measures),
    "kpi_customer_ltv": lambda m: kpis.customer_ltv(m.customer_summary),
    "kpi_monthly_order_trend": lambda m: kpis.monthly_order_trend(m.order_measures),
    "kpi_store_share": lambda m: kpis.store_share(m.revenue_by_store),
    "kpi_store_year_growth": lambda m: kpis.store_year_growth(m.revenue_by_store),
    "kpi_category_unit_value": lambda m: kpis.category_unit_value(m.revenue_by_category),
    "kpi_top_5_products": lambda m: kpis.best_ranked_products(m.product_sales, 5),
    "kpi_brand_concentration": lambda m: kpis.brand_concentration(m.product_sales, 5),
    "kpi_yearly_growth": lambda m: kpis.yearly_growth(m.order_measures),
    "kpi_annual_run_rate": lambda m: kpis.annual_run_rate(m.order_measures),
    "kpi_stock_alerts": lambda m: kpis.stock_alerts(m.stg_stocks, m.stg_stores, m.stg_products),
    "kpi_top_20_customers": lambda m: kpis.top_customers(m.customer_summary, 20),
    "kpi_revenue_concentration": lambda m: kpis.revenue_concentration(m.customer_summary),
    "kpi_lead_time": lambda m: kpis.lead_time(m.order_measures),
}

CHECK_QUERIES: dict[str, Callable[[dict], DataFrame]] = {
    "dq_unique": lambda f: quality.unique(f, checks.UNIQUE),
    "dq_unique_combination": lambda f: quality.unique_combination(f, checks.UNIQUE_COMBINATION),
    "dq_relationships": lambda f: quality.relationships(f, checks.RELATIONSHIPS),
    "dq_accepted_values": lambda f: quality.accepted_values(f, checks.ACCEPTED_VALUES),
    "dq_equal_rowcount": lambda f: quality.equal_rowcount(f, checks.EQUAL_ROWCOUNT),
    "dq_domain_rules": lambda f: quality.domain_rules(f, checks.domain_rules()),
}


def _models(spark: SparkSession, folder: str) -> Models:
    return Models(from_testdata(local_trial(spark), folder))


def _trial(query: Query) -> Query:
    return lambda spark, folder: query(local_trial(spark), folder)


def _model_query(name: str) -> Query:
    return lambda spark, folder: getattr(_models(spark, folder), name)


def _kpi_query(kpi: Callable[[Models], DataFrame]) -> Query:
    return lambda spark, folder: kpi(_models(spark, folder))


def _check_query(check: Callable[[dict], DataFrame]) -> Query:
    return lambda spark, folder: check(checks.ModelFrames(_models(spark, folder)))


def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    """Four of the models read the order facts, so these are written once."""
    models = _models(spark, folder)
    models.keep_order_facts()
    return quality.not_null(checks.ModelFrames(models), checks.NOT_NULL)


def _first_load(models: Models) -> DataFrame:
    """Orders as known three days before the newest one."""
    newest = models.sources["orders"].agg(F.max("order_date")).scalar()
    return models.sources["orders"].where(F.col("order_date") <= F.date_sub(newest, 3))


def orders_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """A first load with every tenth order still in process, then one later run."""
    models = _models(spark, folder)
    table = MonthlyTable(spark, scratch_path(spark, "orders"))
    open_order = F.col("order_id") % 10 == 0
    earlier = _first_load(models).withColumns(
        {
            "order_status": F.when(open_order, 2).otherwise(F.col("order_status")),
            "shipped_date": F.when(open_order, "NULL").otherwise(F.col("shipped_date")),
        }
    )
    pipeline.refresh_orders(Models(with_tables(models.sources, orders=earlier)), table)
    pipeline.refresh_orders(models, table)
    return table.read()


def orders_schema_sync(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table with one column too few and one too many, then one later run."""
    models = _models(spark, folder)
    table = MonthlyTable(spark, scratch_path(spark, "orders"))
    earlier = Models(with_tables(models.sources, orders=_first_load(models))).orders
    table.replace(earlier.drop("order_line_count").withColumn("legacy_code", F.lit("x")))
    pipeline.refresh_orders(models, table)
    return table.read()


def orders_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The order history from three deliveries with repeated and late updates.

    First all orders, every third of them still open; then the open ones as they are now,
    and some orders again; last, older news of every fifth order, which must change nothing.
    """
    models = _models(spark, folder)
    table = MonthlyTable(spark, scratch_path(spark, "orders"))
    news, progress = scratch_path(spark, "news"), scratch_path(spark, "feed")
    totals = keep(models.order_totals, "totals")
    raw = spark.read.schema(SCHEMAS["orders"]).parquet(f"{folder}/orders.parquet")
    number = F.col("o_orderkey")
    still_open = raw.withColumn("o_orderstatus", F.lit("O"))

    def news_of(orders: DataFrame, sequence: int) -> DataFrame:
        return orders.withColumn("updated_at", F.lit(sequence))

    first = news_of(raw.where(number % 3 != 0), 10).unionAll(
        news_of(still_open.where(number % 3 == 0), 10)
    )
    second = news_of(raw.where(number % 3 == 0), 20).unionAll(
        news_of(raw.where((number % 3 != 0) & (number % 7 == 0)), 10)
    )
    for delivery in (first, second, news_of(still_open.where(number % 5 == 0), 5)):
        delivery.write.mode("append").parquet(news)
        stream = spark.readStream.schema(delivery.schema).parquet(news)
        orders = orders_source(spark, folder, stream, "updated_at")
        start_order_feed(
            orders, models.sources, table, progress, order_totals=totals
        ).awaitTermination()
    return table.read()


def orders_line_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The order history from streams of orders and lines that arrive in disorder.

    First lines of orders that are unknown yet, orders that are still open, lines with
    another quantity, and lines that are removed later; then the missing orders and lines
    and all corrections; last, older news, which must change nothing.
    """
    models = _models(spark, folder)
    table = MonthlyTable(spark, scratch_path(spark, "orders"))
    totals = order_totals_table(spark, scratch_path(spark, "totals"))
    places = {n: scratch_path(spark, n) for n in ("orders-in", "lines-in", "feed")}
    orders, lines = models.sources["orders"], models.sources["order_items"]
    lines = lines.withColumn("gone", F.lit(False))
    number, more = F.col("order_id"), {"quantity": F.col("quantity") + 1}
    still_open = {"order_status": F.lit(2), "shipped_date": F.lit("NULL")}
    removed = lines.where(number % 7 == 0).withColumn("item_id", -1 - F.abs("item_id"))
    deliveries = (
        (10, orders.where((number % 4 != 1) & (number % 3 != 0)), lines.where(number % 2 == 0)),
        (10, orders.where((number % 4 != 1) & (number % 3 == 0)).withColumns(still_open), removed),
        (10, None, lines.where((number % 2 == 1) & (number % 5 == 0)).withColumns(more)),
        (20, orders.where((number % 4 == 1) | (number % 3 == 0)), lines.where(number % 2 == 1)),
        (20, None, removed.withColumn("gone", F.lit(True))),
        (5, orders.withColumns(still_open), lines.withColumns(more)),
    )
    for round_, parts in enumerate((deliveries[:3], deliveries[3:5], deliveries[5:])):
        for sequence, some_orders, some_lines in parts:
            stamp = {
                "updated_at": F.lit(sequence),
                "event_time": F.lit(f"2024-01-0{round_ + 1} 00:00:00").cast("timestamp"),
            }
            for place, rows in (("orders-in", some_orders), ("lines-in", some_lines)):
                if rows is not None:
                    rows.withColumns(stamp).write.mode("append").parquet(places[place])
        # What the stream has taken is deleted: its files, and versions no one reads any more.
        streams = [
            spark.readStream.schema(spark.read.parquet(places[p]).schema)
            .option("cleanSource", "delete")
            .parquet(places[p])
            for p in ("orders-in", "lines-in")
        ]
        start_line_feed(
            *streams, models.sources, table, totals, places["feed"]
        ).awaitTermination()
        for stored in (table, totals):
            stored.remove_old(1)
    return table.read()


def _marts_from_changes(mart: str) -> Query:
    """A mart kept since an earlier state of the sources, after all that has changed since.

    Then every seventh order was unknown and every tenth open, others had another date,
    customer or no lines, and there were orders that are gone now.
    """

    def query(spark: SparkSession, folder: str) -> DataFrame:
        models = _models(spark, folder)
        orders, lines = models.sources["orders"], models.sources["order_items"]
        number, gone = F.col("order_id"), F.col("order_id") + 10**9
        then = orders.where(number % 7 != 3).withColumns(
            {
                "order_status": F.when(number % 10 == 0, 2).otherwise(F.col("order_status")),
                "order_date": F.when(number % 11 == 5, F.date_sub("order_date", 40)).otherwise(
                    F.col("order_date")
                ),
                "customer_id": F.when(number % 17 == 4, 1).otherwise(F.col("customer_id")),
            }
        )
        then = then.unionAll(orders.where(number % 13 == 1).withColumn("order_id", gone))
        lines_then = lines.where(number % 19 != 2).unionAll(
            lines.where(number % 13 == 1).withColumn("order_id", gone)
        )
        changed = orders.where(
            (number % 7 == 3) | (number % 10 == 0) | (number % 11 == 5) | (number % 17 == 4)
            | (number % 19 == 2)
        ).select("order_id").unionAll(orders.where(number % 13 == 1).select(gone))
        kept = KeptMarts(spark, scratch_path(spark, "kept"), ranked=mart == "top_products")
        kept.load(Models(with_tables(models.sources, orders=then, order_items=lines_then)))
        kept.apply(models, changed)
        return getattr(kept, mart)(models)

    return query


def rank_scalable(spark: SparkSession, folder: str) -> DataFrame:
    """Every order ranked by revenue, both ways."""
    orders = _models(spark, folder).order_measures.select("order_id", "order_revenue")
    return ranking.with_both_ranks(orders, "order_revenue", "revenue_rank", "revenue_percentile")


# Checks that the test tables do not pass, so that there are rows to show.
FAILING = (
    quality.Failing("not_null", "stg_orders", "shipped_date"),
    quality.Failing("unique", "stg_orders", "customer_id"),
    quality.Failing("accepted_values", "stg_orders", "order_status", accepted=(1, 2, 3)),
    quality.Failing(
        "relationships", "stg_customers", "customer_id", parent=("stg_orders", "customer_id")
    ),
)


def dq_failing_values(spark: SparkSession, folder: str) -> DataFrame:
    """The values behind failures, for one check of each kind."""
    return quality.failing_values(checks.ModelFrames(_models(spark, folder)), FAILING)


def entry(spark: SparkSession) -> DataFrame:
    """Monthly revenue by store on the smallest test tables."""
    return _models(spark, "/root/testdata/sf0.001").revenue_by_store


def queries() -> dict[str, Query]:
    out = {name: _model_query(name) for name in MODEL_QUERIES}
    out.update({name: _kpi_query(kpi) for name, kpi in KPI_QUERIES.items()})
    out.update({name: _check_query(check) for name, check in CHECK_QUERIES.items()})
    out["dq_not_null"] = dq_not_null
    out["orders_incremental"] = orders_incremental
    out["orders_schema_sync"] = orders_schema_sync
    out["orders_stream"] = orders_stream
    out["orders_line_stream"] = orders_line_stream
    for mart in ("revenue_by_store", "revenue_by_category", "top_products", "customer_summary"):
        out[f"{mart}_from_changes"] = _marts_from_changes(mart)
    out["rank_scalable"] = rank_scalable
    out["dq_failing_values"] = dq_failing_values
    if corpus is not None:
        out.update(corpus.queries())
        out["pipeline"] = corpus_pipeline.run
    return {name: _trial(query) for name, query in out.items()}


def oracle_sql() -> dict[str, str]:
    out = oracle.statements()
    if corpus is not None:
        out.update(corpus.oracle_sql())
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
