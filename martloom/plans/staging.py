"""Staging: type, rename and protect the columns of one source table each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import money
from martloom.functions.columns import (
    MISSING,
    as_bigint,
    decode,
    hash_pii,
    safe_bigint,
    safe_date,
)


def stg_brands(brands: DataFrame) -> DataFrame:
    return brands.select("brand_id", "brand_name")


def stg_categories(categories: DataFrame) -> DataFrame:
    return categories.select("category_id", "category_name")


def stg_customers(customers: DataFrame) -> DataFrame:
    """Names stay readable, the email is hashed, phone and address go no further."""
    return customers.select(
        "customer_id", "first_name", "last_name", hash_pii(F.col("email")).alias("email_hash")
    )


def stg_order_items(order_items: DataFrame) -> DataFrame:
    typed = order_items.select(
        "order_id",
        "item_id",
        "product_id",
        as_bigint(order_items, "quantity").alias("quantity"),
        F.col("list_price").cast("double").alias("list_price"),
        F.col("discount").cast("double").alias("discount"),
    )
    quantity, price, discount = (F.col(c) for c in ("quantity", "list_price", "discount"))
    return typed.select(
        "*",
        money.dollars(money.net_price_cents(price, discount)).alias("net_price"),
        money.dollars(money.line_cents(quantity, price, discount)).alias("line_revenue"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    shipped = F.col("shipped_date")
    if dict(orders.dtypes)["shipped_date"] == "string":
        shipped = safe_date(F.nullif(shipped, F.lit(MISSING)))
    return orders.select(
        "order_id",
        "customer_id",
        "store_id",
        "staff_id",
        "order_date",
        "required_date",
        as_bigint(orders, "order_status").alias("order_status"),
        shipped.cast("date").alias("shipped_date"),
    )


def stg_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "brand_id",
        "category_id",
        "product_name",
        as_bigint(products, "model_year").alias("model_year"),
        F.col("list_price").cast("double").alias("list_price"),
    )


def stg_staffs(staffs: DataFrame) -> DataFrame:
    return staffs.select(
        "staff_id",
        "store_id",
        safe_bigint(F.col("manager_id")).alias("manager_id"),
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "phone",
        "email",
        F.col("active").cast("boolean").alias("active"),
        decode(as_bigint(staffs, "active"), {1: "Active", 0: "Inactive"}, "Unknown").alias(
            "active_label"
        ),
    )


def stg_stocks(stocks: DataFrame) -> DataFrame:
    return stocks.select("store_id", "product_id", as_bigint(stocks, "quantity").alias("quantity"))


def stg_stores(stores: DataFrame) -> DataFrame:
    return stores.select(
        "store_id", "store_name", "phone", "email", "street", "city", "state", "zip_code"
    )
