"""Named subqueries, in order of use, that every statement is prefixed with."""

from __future__ import annotations


def key(*parts: str) -> str:
    shown = ", ".join(f"coalesce(CAST({p} AS VARCHAR), chr(1))" for p in parts)
    return f"CAST('0x' || substr(md5(concat_ws('|', {shown})), 1, 15) AS BIGINT)"


def hundredths(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(18,2)) * 100 AS BIGINT)"


def line_amount(quantity: str, price: str, discount: str) -> str:
    """Exact decimal amount, rounded once to cents."""
    return (
        f"ROUND(CAST({quantity} AS DECIMAL(9,0)) * CAST({price} AS DECIMAL(18,8))"
        f" * (1 - CAST({discount} AS DECIMAL(9,8))), 2)"
    )


def cents(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(28,2)) * 100 AS HUGEINT)"


def divide(num: str, den: str) -> str:
    """Whole-number division of non-negative numbers, halves up."""
    return f"((2 * ({num}) + ({den})) // NULLIF(2 * ({den}), 0))"


def mean(total_cents: str, count: str) -> str:
    return f"CAST({divide(total_cents, count)} AS DOUBLE) / 100"


def tenths(num: str, den: str, factor: int = 1) -> str:
    """``factor * num / den`` with one decimal, for either sign of ``num``."""
    size = divide(f"{10 * factor} * abs({num})", den)
    return f"CAST(CASE WHEN {num} < 0 THEN -{size} ELSE {size} END AS DOUBLE) / 10"


SOURCES = {
    "src_customers": """
        SELECT c_custkey AS customer_id, 'Customer' AS first_name,
               substr(c_name, 10) AS last_name, '555-0100' AS phone,
               CASE WHEN c_custkey % 50 <> 0 THEN lower(c_name) || '@example.com' END AS email
        FROM customer""",
    "src_orders": """
        SELECT *, CASE WHEN order_status = 4
                       THEN CAST(order_date + CAST(order_id % 5 AS INTEGER) AS VARCHAR)
                       ELSE 'NULL' END AS shipped_date
        FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                     o_custkey % (SELECT count(*) FROM region) AS store_id,
                     o_orderkey % (SELECT count(*) FROM supplier) AS staff_id,
                     CASE o_orderstatus
                          WHEN 'F' THEN 4
                          WHEN 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END
                          WHEN 'P' THEN CASE WHEN o_orderpriority = '5-LOW' THEN 3 ELSE 4 END
                     END AS order_status,
                     CAST(o_orderdate AS DATE) AS order_date,
                     CAST(o_orderdate AS DATE) + CAST(1 + o_custkey % 3 AS INTEGER)
                         AS required_date
              FROM orders)""",
    "src_order_items": f"""
        SELECT l_orderkey AS order_id,
               {key("l_linenumber", "l_partkey", "l_suppkey", hundredths("l_quantity"),
                    hundredths("l_extendedprice"), hundredths("l_discount"), hundredths("l_tax"),
                    "l_returnflag", "l_linestatus",
                    "CAST(l_shipdate AS DATE) - DATE '1970-01-01'")} AS item_id,
               l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
               l_extendedprice AS list_price, l_discount AS discount
        FROM lineitem""",
    "src_products": f"""
        SELECT p_partkey AS product_id, CAST(substr(p_brand, 7) AS BIGINT) AS brand_id,
               {key("p_type")} AS category_id, p_name AS product_name,
               2016 + p_size % 4 AS model_year, p_retailprice AS list_price
        FROM part""",
    "src_brands": """
        SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS brand_id, p_brand AS brand_name
        FROM part""",
    "src_categories": f"""
        SELECT DISTINCT {key("p_type")} AS category_id, p_type AS category_name FROM part""",
    "src_stores": """
        SELECT CAST(r_regionkey AS BIGINT) AS store_id, r_name AS store_name,
               '555-0101' AS phone, 'store@example.com' AS email, '2 Main Street' AS street,
               (SELECT min(n_name) FROM nation WHERE n_regionkey = r_regionkey) AS city,
               substr((SELECT min(n_name) FROM nation WHERE n_regionkey = r_regionkey), 1, 2)
                   AS state,
               '00000' AS zip_code
        FROM region""",
    "src_staffs": """
        SELECT s_suppkey AS staff_id, CAST(n_regionkey AS BIGINT) AS store_id,
               CASE WHEN s_suppkey = 0 THEN 'NULL'
                    ELSE CAST(s_suppkey // 2 AS VARCHAR) END AS manager_id,
               'Supplier' AS first_name, substr(s_name, 10) AS last_name, '555-0102' AS phone,
               lower(s_name) || '@example.com' AS email,
               CASE WHEN s_suppkey % 7 = 3 THEN 0 ELSE 1 END AS active
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "src_stocks": """
        SELECT store_id, product_id, (product_id * 7 + store_id * 13) % 23 AS quantity
        FROM (SELECT p_partkey AS product_id,
                     unnest(range((SELECT CAST(max(r_regionkey) AS BIGINT) + 1 FROM region)))
                         AS store_id
              FROM part WHERE p_partkey % 101 <> 0)
        WHERE (product_id + store_id) % 17 <> 0""",
}

STAGING = {
    "stg_brands": "SELECT * FROM src_brands",
    "stg_categories": "SELECT * FROM src_categories",
    "stg_customers": """
        SELECT customer_id, first_name, last_name, sha256(email) AS email_hash
        FROM src_customers""",
    "stg_order_items": f"""
        SELECT *, CAST({line_amount("1", "list_price", "discount")} AS DOUBLE) AS net_price,
               CAST({line_amount("quantity", "list_price", "discount")} AS DOUBLE) AS line_revenue
        FROM src_order_items""",
    "stg_orders": """
        SELECT order_id, customer_id, store_id, staff_id, order_date, required_date,
               CAST(order_status AS BIGINT) AS order_status,
               TRY_CAST(NULLIF(shipped_date, 'NULL') AS DATE) AS shipped_date
        FROM src_orders""",
    "stg_products": """
        SELECT product_id, brand_id, category_id, product_name,
               CAST(model_year AS BIGINT) AS model_year, CAST(list_price AS DOUBLE) AS list_price
        FROM src_products""",
    "stg_staffs": """
        SELECT staff_id, store_id, TRY_CAST(manager_id AS BIGINT) AS manager_id, first_name,
               last_name, first_name || ' ' || last_name AS full_name, phone, email,
               active <> 0 AS active,
               CASE WHEN active = 1 THEN 'Active' WHEN active = 0 THEN 'Inactive'
                    ELSE 'Unknown' END AS active_label
        FROM src_staffs""",
    "stg_stocks": "SELECT store_id, product_id, CAST(quantity AS BIGINT) AS quantity FROM src_stocks",
    "stg_stores": "SELECT * FROM src_stores",
}

MODELS = {
    "int_orders_enriched": """
        SELECT o.order_id, o.order_status,
               list_extract(['Pending', 'Processing', 'Rejected', 'Completed'], o.order_status)
                   AS order_status_label,
               o.order_date, o.required_date, o.shipped_date,
               CAST(o.shipped_date - o.required_date AS BIGINT) AS delivery_delay_days,
               o.customer_id, c.first_name AS customer_first_name,
               c.last_name AS customer_last_name,
               coalesce(c.first_name, '') || ' ' || coalesce(c.last_name, '')
                   AS customer_full_name,
               c.email_hash AS customer_email_hash, o.store_id, s.store_name,
               s.city AS store_city, s.state AS store_state, o.staff_id,
               f.first_name AS staff_first_name, f.last_name AS staff_last_name
        FROM stg_orders o
        LEFT JOIN stg_customers c USING (customer_id)
        LEFT JOIN stg_stores s USING (store_id)
        LEFT JOIN stg_staffs f USING (staff_id)""",
    "int_order_items_enriched": f"""
        SELECT i.order_id, i.item_id, i.quantity, i.list_price, i.discount, i.product_id,
               p.product_name, p.model_year, p.list_price AS product_list_price, p.brand_id,
               b.brand_name, p.category_id, g.category_name,
               CAST({line_amount("i.quantity", "i.list_price", "i.discount")} AS DOUBLE)
                   AS line_revenue
        FROM stg_order_items i
        LEFT JOIN stg_products p USING (product_id)
        LEFT JOIN stg_brands b USING (brand_id)
        LEFT JOIN stg_categories g USING (category_id)""",
    "per_order": f"""
        SELECT order_id, sum({cents("line_revenue")}) AS cents,
               CAST(sum(quantity) AS BIGINT) AS units, count(item_id) AS line_count
        FROM int_order_items_enriched GROUP BY order_id""",
    "int_orders_with_revenue": """
        SELECT e.*,
               CASE WHEN order_status = 4 THEN CAST(cents AS DOUBLE) / 100 END AS order_revenue,
               CASE WHEN order_status = 4 THEN units END AS order_units_sold,
               line_count AS order_line_count
        FROM int_orders_enriched e LEFT JOIN per_order USING (order_id)""",
    "mart_orders": """
        SELECT * EXCLUDE (customer_email_hash),
               CASE WHEN shipped_date IS NOT NULL
                    THEN coalesce(delivery_delay_days <= 0, FALSE) END AS is_on_time,
               strftime(order_date, '%Y-%m') AS order_year_month
        FROM int_orders_with_revenue""",
    "completed": f"""
        SELECT *, {cents("order_revenue")} AS cents,
               CAST(date_trunc('month', order_date) AS DATE) AS order_month
        FROM int_orders_with_revenue WHERE order_status = 4""",
    "revenue_by_store": f"""
        SELECT store_id, store_name, store_city, store_state, order_month,
               CAST(sum(cents) AS DOUBLE) / 100 AS total_revenue, count(*) AS order_count,
               {mean("sum(cents)", "count(*)")} AS avg_order_revenue
        FROM completed GROUP BY ALL""",
    "completed_lines": f"""
        SELECT i.*, {cents("i.line_revenue")} AS line_cents, o.order_month
        FROM int_order_items_enriched i JOIN completed o ON o.order_id = i.order_id""",
    "revenue_by_category": """
        SELECT category_id, category_name, order_month,
               CAST(sum(line_cents) AS DOUBLE) / 100 AS total_revenue,
               CAST(sum(quantity) AS BIGINT) AS units_sold,
               count(DISTINCT order_id) AS order_count
        FROM completed_lines GROUP BY ALL""",
    "product_totals": """
        SELECT product_id, product_name, brand_name, category_name,
               sum(line_cents) AS cents, CAST(sum(line_cents) AS DOUBLE) / 100 AS total_revenue,
               CAST(sum(quantity) AS BIGINT) AS units_sold,
               count(DISTINCT order_id) AS order_count
        FROM completed_lines GROUP BY product_id, product_name, brand_name, category_name""",
    "top_products": """
        SELECT * EXCLUDE (cents),
               dense_rank() OVER (ORDER BY cents DESC NULLS LAST) AS revenue_rank
        FROM product_totals""",
    "customer_summary": f"""
        SELECT customer_id, customer_full_name, count(DISTINCT order_id) AS total_order_count,
               min(order_date) AS first_order_date, max(order_date) AS last_order_date,
               count(DISTINCT order_id) FILTER (WHERE order_status = 4) AS completed_order_count,
               coalesce(CAST(sum({cents("order_revenue")}) AS DOUBLE) / 100, 0) AS lifetime_value,
               {mean(f"sum({cents('order_revenue')})",
                     "count(DISTINCT order_id) FILTER (WHERE order_status = 4)")} AS avg_basket
        FROM int_orders_with_revenue GROUP BY customer_id, customer_full_name""",
}


def prefix(*more: tuple[str, str]) -> str:
    named = {**SOURCES, **STAGING, **MODELS, **dict(more)}
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in named.items())
