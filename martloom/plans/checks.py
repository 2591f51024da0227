"""The checks declared on the models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.columns import ORDER_STATUS
from martloom.operators import quality
from martloom.operators.quality import AcceptedValues, Relationship, Rule
from martloom.plans.models import Models
from martloom.session import keep
from martloom.sources.tables import SOURCE_TABLES

# Columns that must have a value, per model.
NOT_NULL = {
    "stg_brands": ("brand_id", "brand_name"),
    "stg_categories": ("category_id", "category_name"),
    "stg_customers": ("customer_id",),
    "stg_order_items": (
        "order_id", "item_id", "product_id", "quantity", "list_price", "discount", "net_price",
        "line_revenue",
    ),
    "stg_orders": (
        "order_id", "customer_id", "store_id", "staff_id", "order_status", "order_date",
        "required_date",
    ),
    "stg_products": (
        "product_id", "brand_id", "category_id", "product_name", "model_year", "list_price",
    ),
    "stg_staffs": (
        "staff_id", "store_id", "first_name", "last_name", "full_name", "active", "active_label",
    ),
    "stg_stocks": ("store_id", "product_id", "quantity"),
    "stg_stores": ("store_id", "store_name", "city", "state"),
    "int_order_items_enriched": (
        "order_id", "item_id", "quantity", "list_price", "discount", "line_revenue",
        "product_id", "brand_id", "category_id",
    ),
    "int_orders_enriched": (
        "order_id", "order_status", "order_status_label", "order_date", "required_date",
        "customer_id", "store_id", "staff_id",
    ),
    "int_orders_with_revenue": (
        "order_id", "order_status", "order_status_label", "order_date", "customer_id",
        "store_id", "staff_id",
    ),
    "customer_summary": (
        "customer_id", "customer_full_name", "total_order_count", "first_order_date",
        "last_order_date", "completed_order_count", "lifetime_value",
    ),
    "orders": (
        "order_id", "order_status", "order_status_label", "order_date", "required_date",
        "order_year_month", "customer_id", "store_id", "store_name", "staff_id",
    ),
    "revenue_by_category": (
        "category_id", "category_name", "order_month", "total_revenue", "units_sold",
        "order_count",
    ),
    "revenue_by_store": (
        "store_id", "store_name", "store_city", "store_state", "order_month", "total_revenue",
        "order_count",
    ),
    "top_products": (
        "product_id", "product_name", "brand_name", "category_name", "total_revenue",
        "units_sold", "order_count", "revenue_rank",
    ),
}

# Single-column keys.
UNIQUE = [
    ("stg_brands", "brand_id"),
    ("stg_categories", "category_id"),
    ("stg_customers", "customer_id"),
    ("stg_orders", "order_id"),
    ("stg_products", "product_id"),
    ("stg_staffs", "staff_id"),
    ("stg_stores", "store_id"),
    ("int_orders_enriched", "order_id"),
    ("int_orders_with_revenue", "order_id"),
    ("customer_summary", "customer_id"),
    ("orders", "order_id"),
    ("top_products", "product_id"),
]

# Keys of several columns.
UNIQUE_COMBINATION = [
    ("stg_order_items", ("order_id", "item_id")),
    ("stg_stocks", ("store_id", "product_id")),
    ("int_order_items_enriched", ("order_id", "item_id")),
    ("revenue_by_category", ("category_id", "order_month")),
    ("revenue_by_store", ("store_id", "order_month")),
]

# References between models.
RELATIONSHIPS = [
    Relationship("stg_order_items", "order_id", "stg_orders", "order_id"),
    Relationship("stg_orders", "customer_id", "stg_customers", "customer_id"),
    Relationship("stg_products", "brand_id", "stg_brands", "brand_id"),
    Relationship("stg_products", "category_id", "stg_categories", "category_id"),
    Relationship("stg_staffs", "store_id", "stg_stores", "store_id"),
    Relationship("stg_staffs", "manager_id", "stg_staffs", "staff_id"),
    Relationship("stg_stocks", "store_id", "stg_stores", "store_id"),
    Relationship("stg_stocks", "product_id", "stg_products", "product_id"),
    # The left joins of the intermediate layer rely on these three as well.
    Relationship("stg_orders", "store_id", "stg_stores", "store_id"),
    Relationship("stg_orders", "staff_id", "stg_staffs", "staff_id"),
    Relationship("stg_order_items", "product_id", "stg_products", "product_id"),
]

_CODES = tuple(ORDER_STATUS)
_LABELS = tuple(ORDER_STATUS.values())

# Columns with a closed list of values.
ACCEPTED_VALUES = [
    AcceptedValues("stg_orders", "order_status", _CODES),
    AcceptedValues("stg_staffs", "active_label", ("Active", "Inactive")),
    AcceptedValues("int_orders_enriched", "order_status", _CODES),
    AcceptedValues("int_orders_enriched", "order_status_label", _LABELS),
    AcceptedValues("int_orders_with_revenue", "order_status", _CODES),
    AcceptedValues("orders", "order_status", _CODES),
    AcceptedValues("orders", "order_status_label", _LABELS),
]

# Models that must have as many rows as another, the last two because a
# join that multiplied rows would show there.
EQUAL_ROWCOUNT = [
    *[
        ("equal_rowcount", f"stg_{table}", f"source_{table}")
        for table in SOURCE_TABLES
        if table != "customers"
    ],
    ("equal_rowcount", "int_orders_with_revenue", "int_orders_enriched"),
    ("equal_rowcount", "orders", "int_orders_with_revenue"),
    ("int_orders_no_row_explosion", "int_orders_enriched", "stg_orders"),
    ("int_order_items_no_row_explosion", "int_order_items_enriched", "stg_order_items"),
]


def domain_rules() -> list[Rule]:
    """Rules on values. Built on call, since columns need a running session."""
    col = F.col
    return [
        Rule(
            "order_items_positive_values",
            "stg_order_items",
            ("order_id", "item_id", "quantity", "list_price", "discount"),
            (col("quantity") <= 0) | (col("list_price") <= 0) | ~col("discount").between(0, 1),
        ),
        Rule(
            "orders_date_consistency",
            "stg_orders",
            ("order_id", "order_date", "required_date", "shipped_date"),
            (col("required_date") < col("order_date")) | (col("shipped_date") < col("order_date")),
        ),
        Rule(
            "stocks_non_negative_quantity",
            "stg_stocks",
            ("store_id", "product_id", "quantity"),
            col("quantity") < 0,
        ),
        Rule(
            "revenue_by_store_positive_revenue",
            "revenue_by_store",
            ("store_id", "order_month", "total_revenue"),
            col("total_revenue") <= 0,
        ),
        Rule(
            "customer_summary_lifetime_value_non_negative",
            "customer_summary",
            ("customer_id", "lifetime_value"),
            col("lifetime_value") < 0,
        ),
    ]


class ModelFrames(dict):
    """Frames by model name, taken from ``models`` unless a stored table is given."""

    def __init__(self, models: Models, stored: dict[str, DataFrame] | None = None):
        super().__init__(stored or {})
        self._models = models

    def __missing__(self, name: str) -> DataFrame:
        if name.startswith("source_"):
            self[name] = self._models.sources[name.removeprefix("source_")]
        else:
            self[name] = getattr(self._models, name)
        return self[name]


def checked_columns(model: str) -> list[str]:
    """The columns of a model that any check reads."""
    names = set(NOT_NULL.get(model, ()))
    names.update(column for name, column in UNIQUE if name == model)
    names.update(c for name, columns in UNIQUE_COMBINATION if name == model for c in columns)
    names.update(check.column for check in ACCEPTED_VALUES if check.model == model)
    return sorted(names)


def keep_joined(frames: dict[str, DataFrame]) -> None:
    """Write the checked columns of the joined models once.

    Up to six checks read each of them; without this every one would join again.
    """
    for model in ("int_orders_enriched", "int_orders_with_revenue", "int_order_items_enriched"):
        frames[model] = keep(frames[model].select(*checked_columns(model)), model)


def run_all(frames: dict[str, DataFrame]) -> DataFrame:
    """Every check, with its outcome."""
    keep_joined(frames)
    results = [
        quality.not_null(frames, NOT_NULL),
        quality.unique(frames, UNIQUE),
        quality.unique_combination(frames, UNIQUE_COMBINATION),
        quality.relationships(frames, RELATIONSHIPS),
        quality.accepted_values(frames, ACCEPTED_VALUES),
        quality.equal_rowcount(frames, EQUAL_ROWCOUNT),
        quality.domain_rules(frames, domain_rules()),
    ]
    outcome = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    return quality._union(results).withColumn("status", outcome)


class BuildChecks:
    """Checks counted while a build writes: the order lines, the orders, and the marts.

    An incremental build observes the months of the order history that it writes. Lines are
    counted before a shuffle: an executor lost at that moment may let a failure count twice,
    but not make a check pass or fail. Keys and references need a shuffle of their own and
    are left to ``run_all``.
    """

    MODELS = (
        "stg_order_items", "stg_orders", "orders", "revenue_by_store", "revenue_by_category",
        "top_products", "customer_summary",
    )

    def __init__(self):
        self._full = False
        self._observed = {
            model: quality.Observed(
                model,
                NOT_NULL[model],
                [c for c in ACCEPTED_VALUES if c.model == model],
                [r for r in domain_rules() if r.model == model],
            )
            for model in self.MODELS
        }

    def __getitem__(self, model: str) -> quality.Observed:
        return self._observed[model]

    def all_orders_written(self) -> None:
        """The build writes all orders, so that their number can be compared."""
        self._full = True

    def outcomes(self, spark: SparkSession) -> DataFrame:
        """The checks of all models written: model, test, column_name, failures, status."""
        written = [o for o in self._observed.values() if o.written]
        found = [row for observed in written for row in observed.failures()]
        if self._full:
            more = abs(self["orders"].rows - self["stg_orders"].rows)
            found.append(("orders", "int_orders_no_row_explosion", "stg_orders", more))
        return quality.outcomes(spark, found)
