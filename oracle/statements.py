"""One statement per registered query."""

from __future__ import annotations

from oracle.views import STAGING, cents, mean, prefix, tenths

# Columns that must have a value, per model.
NOT_NULL = """
stg_brands: brand_id brand_name
stg_categories: category_id category_name
stg_customers: customer_id
stg_order_items: order_id item_id product_id quantity list_price discount net_price line_revenue
stg_orders: order_id customer_id store_id staff_id order_status order_date required_date
stg_products: product_id brand_id category_id product_name model_year list_price
stg_staffs: staff_id store_id first_name last_name full_name active active_label
stg_stocks: store_id product_id quantity
stg_stores: store_id store_name city state
int_order_items_enriched: order_id item_id quantity list_price discount line_revenue product_id brand_id category_id
int_orders_enriched: order_id order_status order_status_label order_date required_date customer_id store_id staff_id
int_orders_with_revenue: order_id order_status order_status_label order_date customer_id store_id staff_id
customer_summary: customer_id customer_full_name total_order_count first_order_date last_order_date completed_order_count lifetime_value
orders: order_id order_status order_status_label order_date required_date order_year_month customer_id store_id store_name staff_id
revenue_by_category: category_id category_name order_month total_revenue units_sold order_count
revenue_by_store: store_id store_name store_city store_state order_month total_revenue order_count
top_products: product_id product_name brand_name category_name total_revenue units_sold order_count revenue_rank
"""

# Keys, references and closed lists of values.
UNIQUE = """
stg_brands: brand_id
stg_categories: category_id
stg_customers: customer_id
stg_orders: order_id
stg_products: product_id
stg_staffs: staff_id
stg_stores: store_id
int_orders_enriched: order_id
int_orders_with_revenue: order_id
customer_summary: customer_id
orders: order_id
top_products: product_id
"""
COMBINATIONS = """
stg_order_items: order_id item_id
stg_stocks: store_id product_id
int_order_items_enriched: order_id item_id
revenue_by_category: category_id order_month
revenue_by_store: store_id order_month
"""
REFERENCES = """
stg_order_items order_id stg_orders order_id
stg_orders customer_id stg_customers customer_id
stg_products brand_id stg_brands brand_id
stg_products category_id stg_categories category_id
stg_staffs store_id stg_stores store_id
stg_staffs manager_id stg_staffs staff_id
stg_stocks store_id stg_stores store_id
stg_stocks product_id stg_products product_id
stg_orders store_id stg_stores store_id
stg_orders staff_id stg_staffs staff_id
stg_order_items product_id stg_products product_id
"""
CODES = "1, 2, 3, 4"
LABELS = "'Pending', 'Processing', 'Rejected', 'Completed'"
VALUES = [
    ("stg_orders", "order_status", CODES),
    ("stg_staffs", "active_label", "'Active', 'Inactive'"),
    ("int_orders_enriched", "order_status", CODES),
    ("int_orders_enriched", "order_status_label", LABELS),
    ("int_orders_with_revenue", "order_status", CODES),
    ("orders", "order_status", CODES),
    ("orders", "order_status_label", LABELS),
]


def _table(model: str) -> str:
    """The order history is called mart_orders here: a raw table has its name."""
    if model == "orders":
        return "mart_orders"
    return model.replace("source_", "src_")


def _row(model: str, test: str, column: str, failures: str, source: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{test}' AS test, '{column}' AS column_name,"
        f" CAST({failures} AS BIGINT) AS failures FROM {source}"
    )


def _lists(text: str):
    for line in text.strip().splitlines():
        model, columns = line.split(": ")
        yield model, columns.split()


def _checks() -> dict[str, str]:
    null_rows = [
        _row(m, "not_null", c, f"count(*) - count({c})", _table(m))
        for m, columns in _lists(NOT_NULL)
        for c in columns
    ]
    unique = [
        _row(m, "unique", c, "count(*)",
             f"(SELECT {c} FROM {_table(m)} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        for m, (c,) in _lists(UNIQUE)
    ]
    combined = [
        _row(m, "unique_combination_of_columns", ",".join(c), "count(*)",
             f"(SELECT 1 FROM {_table(m)} GROUP BY {', '.join(c)} HAVING count(*) > 1)")
        for m, c in _lists(COMBINATIONS)
    ]
    references = [
        _row(m, "relationships", c, "count(*)",
             f"{m} child WHERE {c} IS NOT NULL AND NOT EXISTS"
             f" (SELECT 1 FROM {p} parent WHERE parent.{k} = child.{c})")
        for m, c, p, k in (line.split() for line in REFERENCES.strip().splitlines())
    ]
    values = [
        _row(m, "accepted_values", c, f"count(DISTINCT {c})", f"{_table(m)} WHERE {c} NOT IN ({v})")
        for m, c, v in VALUES
    ]
    pairs = [
        ("equal_rowcount", t, t.replace("stg_", "source_")) for t in STAGING if t != "stg_customers"
    ]
    pairs += [
        ("equal_rowcount", "int_orders_with_revenue", "int_orders_enriched"),
        ("equal_rowcount", "orders", "int_orders_with_revenue"),
        ("int_orders_no_row_explosion", "int_orders_enriched", "stg_orders"),
        ("int_order_items_no_row_explosion", "int_order_items_enriched", "stg_order_items"),
    ]
    counts = [
        _row(m, test, other, f"abs(count(*) - (SELECT count(*) FROM {_table(other)}))", _table(m))
        for test, m, other in pairs
    ]
    rules = [
        _row("stg_order_items", "order_items_positive_values",
             "order_id,item_id,quantity,list_price,discount", "count(*)",
             "stg_order_items WHERE quantity <= 0 OR list_price <= 0"
             " OR discount < 0 OR discount > 1"),
        _row("stg_orders", "orders_date_consistency",
             "order_id,order_date,required_date,shipped_date", "count(*)",
             "stg_orders WHERE least(required_date, shipped_date) < order_date"),
        _row("stg_stocks", "stocks_non_negative_quantity", "store_id,product_id,quantity",
             "count(*)", "stg_stocks WHERE quantity < 0"),
        _row("revenue_by_store", "revenue_by_store_positive_revenue",
             "store_id,order_month,total_revenue", "count(*)",
             "revenue_by_store WHERE total_revenue <= 0"),
        _row("customer_summary", "customer_summary_lifetime_value_non_negative",
             "customer_id,lifetime_value", "count(*)", "customer_summary WHERE lifetime_value < 0"),
    ]
    groups = {
        "dq_not_null": null_rows,
        "dq_unique": unique,
        "dq_unique_combination": combined,
        "dq_relationships": references,
        "dq_accepted_values": values,
        "dq_equal_rowcount": counts,
        "dq_domain_rules": rules,
    }
    return {name: " UNION ALL ".join(rows) for name, rows in groups.items()}


def _analyses() -> dict[str, str]:
    return {
        "late_deliveries_by_store": f"""
            SELECT store_name, count(*) AS total_completed_orders,
                   count(*) - count(late) AS on_time_orders, count(late) AS late_orders,
                   {tenths("count(late)", "count(*)", 100)} AS late_delivery_rate_pct,
                   {tenths("sum(late)", "count(late)")} AS avg_delay_days_when_late,
                   max(late) AS max_delay_days
            FROM (SELECT store_id, store_name,
                         CASE WHEN delivery_delay_days > 0 THEN delivery_delay_days END AS late
                  FROM mart_orders WHERE order_status = 4 AND shipped_date IS NOT NULL)
            GROUP BY store_id, store_name""",
        "low_stock_analysis": """
            SELECT product_name, brand_name, category_name, units_sold, total_revenue,
                   sales_percentile, store_name, quantity AS stock_quantity,
                   CASE quantity WHEN 0 THEN 'Out of stock' ELSE 'Low stock' END AS stock_status,
                   CASE WHEN sales_percentile >= 0.8 THEN 'HIGH'
                        WHEN sales_percentile >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END
                       AS restock_priority
            FROM (SELECT *, percent_rank() OVER (ORDER BY units_sold NULLS FIRST)
                                AS sales_percentile
                  FROM product_totals)
            JOIN (SELECT * FROM stg_stocks WHERE quantity <= 5) USING (product_id)
            LEFT JOIN stg_stores USING (store_id)""",
        "stock_top_products": """
            SELECT revenue_rank, product_name, brand_name, category_name, total_revenue,
                   units_sold, store_name, quantity AS stock_quantity,
                   CASE WHEN quantity = 0 THEN 'Out of stock'
                        WHEN quantity BETWEEN 1 AND 5 THEN 'Low stock'
                        ELSE 'In stock' END AS stock_status
            FROM top_products LEFT JOIN stg_stocks USING (product_id)
            LEFT JOIN stg_stores USING (store_id)
            WHERE revenue_rank <= 3""",
    }


def _kpis() -> dict[str, str]:
    revenue = cents("total_revenue")
    order = cents("order_revenue")
    growth = tenths("cents - before", "before", 100)
    return {
        "kpi_total_revenue": f"""
            SELECT CAST(sum({revenue}) AS DOUBLE) / 100 AS total_revenue,
                   CAST(sum(order_count) AS BIGINT) AS order_count
            FROM revenue_by_store""",
        "kpi_total_revenue_store_period": f"""
            SELECT CAST(sum({revenue}) AS DOUBLE) / 100 AS total_revenue,
                   CAST(sum(order_count) AS BIGINT) AS order_count
            FROM revenue_by_store
            WHERE store_id = 1 AND order_month BETWEEN DATE '1996-01-01' AND DATE '1997-12-01'""",
        "kpi_monthly_revenue_by_store":
            "SELECT store_id, store_name, order_month, total_revenue FROM revenue_by_store",
        "kpi_top_10_products": """
            SELECT product_id, product_name, brand_name, category_name, total_revenue
            FROM product_totals ORDER BY cents DESC NULLS LAST, product_id NULLS FIRST LIMIT 10""",
        "kpi_revenue_share_by_category": f"""
            SELECT category_id, category_name, CAST(cents AS DOUBLE) / 100 AS total_revenue,
                   {tenths("cents", "total", 100)} AS revenue_share_pct
            FROM (SELECT category_id, category_name, sum({revenue}) AS cents,
                         sum(sum({revenue})) OVER () AS total
                  FROM revenue_by_category GROUP BY category_id, category_name)""",
        "kpi_basket_per_order": f"""
            SELECT count(*) AS completed_orders,
                   {mean(f"sum({order})", "count(*)")} AS avg_basket_per_order
            FROM mart_orders WHERE order_status = 4""",
        "kpi_basket_per_customer": f"""
            SELECT count(avg_basket) AS buying_customers,
                   {mean(f"sum({cents('avg_basket')})", "count(avg_basket)")}
                       AS avg_basket_per_customer
            FROM customer_summary""",
        "kpi_delivery_performance": f"""
            SELECT count(*) AS shipped_orders, count(*) - count(late) AS on_time_orders,
                   count(late) AS late_orders,
                   {tenths("count(*) - count(late)", "count(*)", 100)} AS on_time_rate_pct,
                   {tenths("count(late)", "count(*)", 100)} AS late_rate_pct,
                   {tenths("sum(late)", "count(late)")} AS avg_delay_days_when_late
            FROM (SELECT CASE WHEN delivery_delay_days > 0 THEN delivery_delay_days END AS late
                  FROM mart_orders WHERE order_status = 4 AND shipped_date IS NOT NULL)""",
        "kpi_customer_ltv":
            "SELECT customer_id, customer_full_name, lifetime_value FROM customer_summary",
        "kpi_monthly_order_trend": f"""
            SELECT order_year_month, count(*) AS order_count,
                   count(*) FILTER (WHERE order_status = 4) AS completed_order_count,
                   CAST(sum({order}) AS DOUBLE) / 100 AS total_revenue
            FROM mart_orders GROUP BY order_year_month""",
        "kpi_store_share": f"""
            SELECT store_id, store_name, CAST(cents AS DOUBLE) / 100 AS total_revenue,
                   {tenths("cents", "total", 100)} AS revenue_share_pct, order_count
            FROM (SELECT store_id, store_name, sum({revenue}) AS cents,
                         CAST(sum(order_count) AS BIGINT) AS order_count,
                         sum(sum({revenue})) OVER () AS total
                  FROM revenue_by_store GROUP BY store_id, store_name)""",
        "kpi_store_year_growth": f"""
            SELECT store_id, store_name, order_year, CAST(cents AS DOUBLE) / 100 AS total_revenue,
                   {growth} AS growth_pct
            FROM (SELECT *, sum(cents) OVER (PARTITION BY store_id ORDER BY order_year
                                RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS before
                  FROM (SELECT store_id, store_name, year(order_month) AS order_year,
                               sum({revenue}) AS cents
                        FROM revenue_by_store GROUP BY ALL))""",
        "kpi_category_unit_value": f"""
            SELECT category_id, category_name, CAST(cents AS DOUBLE) / 100 AS total_revenue,
                   CAST(units AS BIGINT) AS units_sold, {mean("cents", "units")} AS revenue_per_unit
            FROM (SELECT category_id, category_name, sum({revenue}) AS cents,
                         sum(units_sold) AS units
                  FROM revenue_by_category GROUP BY ALL)""",
        "kpi_top_5_products": """
            SELECT revenue_rank, product_id, product_name, brand_name, category_name,
                   total_revenue, units_sold
            FROM top_products WHERE revenue_rank <= 5""",
        "kpi_brand_concentration": f"""
            SELECT brand_name, n AS product_count, CAST(cents AS DOUBLE) / 100 AS total_revenue,
                   {tenths("cents", "total", 100)} AS revenue_share_pct
            FROM (SELECT brand_name, count(*) AS n, sum({revenue}) AS cents,
                         sum(sum({revenue})) OVER () AS total
                  FROM top_products WHERE revenue_rank <= 5 GROUP BY brand_name)""",
        "kpi_yearly_growth": f"""
            SELECT order_year, CAST(cents AS DOUBLE) / 100 AS total_revenue, order_count,
                   {growth} AS growth_pct
            FROM (SELECT *, sum(cents) OVER (ORDER BY order_year
                                RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS before
                  FROM (SELECT year(order_date) AS order_year, sum({order}) AS cents,
                               count(*) AS order_count
                        FROM mart_orders WHERE order_status = 4 GROUP BY 1))""",
        "kpi_annual_run_rate": f"""
            SELECT order_year, months AS months_present,
                   CAST(cents AS DOUBLE) / 100 AS total_revenue,
                   {mean("12 * cents", "months")} AS annual_run_rate
            FROM (SELECT year(order_date) AS order_year, sum({order}) AS cents,
                         count(DISTINCT month(order_date)) AS months
                  FROM mart_orders WHERE order_status = 4 GROUP BY 1)""",
        "kpi_stock_alerts": """
            SELECT store_id, store_name, product_id, product_name, quantity AS stock_quantity,
                   CASE quantity WHEN 0 THEN 'Out of stock' ELSE 'Low stock' END AS stock_status
            FROM stg_stocks LEFT JOIN stg_products USING (product_id)
            LEFT JOIN stg_stores USING (store_id)
            WHERE quantity <= 5""",
        "kpi_top_20_customers": """
            SELECT * FROM customer_summary
            ORDER BY lifetime_value DESC, customer_id NULLS FIRST LIMIT 20""",
        "kpi_revenue_concentration": f"""
            SELECT tenth AS customer_tenth, n AS customer_count,
                   CAST(cents AS DOUBLE) / 100 AS total_revenue,
                   {tenths("cents", "total", 100)} AS revenue_share_pct
            FROM (SELECT CAST(least(floor(position * 10), 9) + 1 AS BIGINT) AS tenth,
                         count(*) AS n, sum({cents("lifetime_value")}) AS cents,
                         sum(sum({cents("lifetime_value")})) OVER () AS total
                  FROM (SELECT lifetime_value,
                               percent_rank() OVER (ORDER BY lifetime_value DESC) AS position
                        FROM customer_summary)
                  GROUP BY 1)""",
        "kpi_lead_time": f"""
            SELECT count(*) AS shipped_orders,
                   {tenths("sum(shipped_date - order_date)", "count(*)")} AS avg_lead_time_days
            FROM mart_orders WHERE order_status = 4 AND shipped_date IS NOT NULL""",
        "rank_scalable": """
            SELECT order_id, order_revenue,
                   dense_rank() OVER (ORDER BY order_revenue DESC NULLS LAST) AS revenue_rank,
                   percent_rank() OVER (ORDER BY order_revenue ASC NULLS FIRST)
                       AS revenue_percentile
            FROM mart_orders""",
        "dq_failing_values": """
            SELECT 'stg_orders' AS model, 'not_null' AS test, 'shipped_date' AS column_name,
                   CAST(NULL AS VARCHAR) AS value, count(*) AS rows
            FROM stg_orders WHERE shipped_date IS NULL HAVING count(*) > 0
            UNION ALL
            SELECT 'stg_orders', 'unique', 'customer_id', CAST(customer_id AS VARCHAR), count(*)
            FROM stg_orders WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(*) > 1
            UNION ALL
            SELECT 'stg_orders', 'accepted_values', 'order_status', CAST(order_status AS VARCHAR),
                   count(*)
            FROM stg_orders WHERE order_status NOT IN (1, 2, 3) GROUP BY order_status
            UNION ALL
            SELECT 'stg_customers', 'relationships', 'customer_id', CAST(customer_id AS VARCHAR),
                   count(*)
            FROM stg_customers WHERE customer_id NOT IN
                (SELECT customer_id FROM stg_orders WHERE customer_id IS NOT NULL)
            GROUP BY customer_id""",
    }


def _stored() -> dict[str, str]:
    """The order history after a first load and one later run (see the entry module)."""
    first_load = "SELECT max(order_date) - 3 FROM stg_orders"
    cutoff = (
        "SELECT max(order_date) - 7 AS day FROM stg_orders"
        f" WHERE order_date <= ({first_load})"
    )
    stale = "order_date < (SELECT day FROM cutoff) AND order_id % 10 = 0"
    cleared = "shipped_date delivery_delay_days is_on_time order_revenue order_units_sold".split()
    incremental = ", ".join(f"CASE WHEN NOT stale THEN {c} END AS {c}" for c in cleared)
    return {
        "orders_incremental": prefix(("cutoff", cutoff)) + f"""
            SELECT * EXCLUDE (stale) REPLACE (
                CASE WHEN stale THEN 2 ELSE order_status END AS order_status,
                CASE WHEN stale THEN 'Processing' ELSE order_status_label END
                    AS order_status_label, {incremental})
            FROM (SELECT *, {stale} AS stale FROM mart_orders)""",
        "orders_schema_sync": prefix(("cutoff", cutoff)) + """
            SELECT * REPLACE (
                CASE WHEN order_date >= (SELECT day FROM cutoff) THEN order_line_count END
                    AS order_line_count)
            FROM mart_orders""",
        "orders_stream": prefix() + "SELECT * FROM mart_orders",
        "orders_line_stream": prefix() + "SELECT * FROM mart_orders",
        **{
            f"{mart}_from_changes": prefix() + f"SELECT * FROM {mart}"
            for mart in (
                "revenue_by_store", "revenue_by_category", "top_products", "customer_summary"
            )
        },
    }


def statements() -> dict[str, str]:
    models = [*STAGING, "int_orders_enriched", "int_order_items_enriched",
              "int_orders_with_revenue", "orders", "revenue_by_store", "revenue_by_category",
              "top_products", "customer_summary"]
    bodies = {name: f"SELECT * FROM {_table(name)}" for name in models}
    bodies.update(_analyses())
    bodies.update(_checks())
    bodies.update(_kpis())
    out = {name: f"{prefix()}\n{body}" for name, body in bodies.items()}
    out.update(_stored())
    return out


