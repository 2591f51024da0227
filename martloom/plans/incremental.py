"""Monthly marts and the customer summary kept up to date from changed orders.

The order facts are stored with what each order holds of every category. An upsert of
changed orders tells their rows before and after as signed differences. Sums and counts
by month take the differences; first and last days and customers' figures cannot be
subtracted, so a customer's month is summed again from the facts of that month, and a
customer from his or her months. Products are summed over what each order holds of them;
their ranking is kept by range of revenue, so that a change writes the ranges it touches and
shifts the ranks of the others. A change reads the months, customers and ranges it touches,
not the lines and orders of all others, and the marts equal those that are built anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.columns import COMPLETED, month_of, year_month
from martloom.operators.kept_ranks import RankedValues
from martloom.operators.sums import GroupTable
from martloom.operators.tables import MonthlyTable
from martloom.plans import marts
from martloom.plans.models import Models
from martloom.session import keep, temporary_tables

CENTS = "decimal(38,0)"
# Customers, and products, are stored in so many parts.
CUSTOMER_PARTS = 64


def _amounts(sign: Column, **values: Column) -> list[Column]:
    """Signed amounts and, for each, how many rows have one: a sum of none is missing."""
    out = []
    for name, value in values.items():
        kind = "bigint" if name == "units" else CENTS
        out.append((F.coalesce(value, F.lit(0)) * sign).cast(kind).alias(name))
        out.append(F.when(value.isNotNull(), sign).otherwise(0).cast("bigint").alias(f"{name}_rows"))
    return out


def _shown(name: str) -> Column:
    return F.when(F.col(f"{name}_rows") > 0, F.col(name)).alias(name)


def _done() -> Column:
    return F.col("order_status") == COMPLETED


def store_differences(changes: DataFrame) -> DataFrame:
    sign = F.col("sign")
    return changes.where(_done()).select(
        "store_id",
        month_of(F.col("order_date")).alias("order_month"),
        sign.cast("bigint").alias("order_count"),
        *_amounts(sign, cents=F.col("revenue_cents")),
    )


def category_differences(changes: DataFrame) -> DataFrame:
    sign = F.col("sign")
    held = changes.where(_done()).select("order_date", "sign", F.explode("categories").alias("c"))
    return held.select(
        "c.category_id",
        month_of(F.col("order_date")).alias("order_month"),
        sign.cast("bigint").alias("order_count"),
        *_amounts(sign, cents=F.col("c.cents"), units=F.col("c.units")),
    )


def product_differences(held: DataFrame) -> DataFrame:
    """Signed figures by product from what orders hold of them."""
    sign = F.col("sign")
    return held.select(
        "product_id",
        sign.cast("bigint").alias("order_count"),
        *_amounts(sign, cents=F.col("cents"), units=F.col("units")),
    )


def _summed(differences: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    kinds = dict(differences.dtypes)
    figures = [c for c in differences.columns if c not in keys]
    return differences.groupBy(*keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in figures])


def customer_months(facts: DataFrame) -> DataFrame:
    """A customer's orders by month. Orders without a customer are one customer's."""
    done = F.when(_done(), 1).otherwise(0)
    cents = F.when(_done() & F.col("customer_id").isNotNull(), F.col("revenue_cents"))
    return facts.groupBy(
        "customer_id", month_of(F.col("order_date")).alias("order_month")
    ).agg(
        F.count("*").alias("orders"),
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
        F.sum(done).cast("bigint").alias("done"),
        F.sum(cents).cast(CENTS).alias("cents"),
    )


def customers(months: DataFrame) -> DataFrame:
    return months.groupBy("customer_id").agg(
        F.sum("orders").alias("total_order_count"),
        F.min("first_day").alias("first_order_date"),
        F.max("last_day").alias("last_order_date"),
        F.when(F.col("customer_id").isNotNull(), F.sum("done")).otherwise(0).alias("completed_order_count"),
        F.sum("cents").cast(CENTS).alias("cents"),
    )


class KeptMarts:
    """Stored facts, and the figures of M5, M6, M7 and M8 that follow from them.

    Without ``ranked``, products and their ranking (M7) are not kept.
    """

    def __init__(self, spark: SparkSession, base: str, ranked: bool = True):
        self.spark, self.ranked = spark, ranked
        month = year_month(F.col("order_month"))
        bucket = F.pmod(F.xxhash64("customer_id"), F.lit(CUSTOMER_PARTS))
        root = base.rstrip("/")
        self.facts = MonthlyTable(spark, f"{root}/facts", ranged=False)
        self.stores = GroupTable(spark, f"{root}/stores", ("store_id", "order_month"), month)
        self.categories = GroupTable(
            spark, f"{root}/categories", ("category_id", "order_month"), month
        )
        self.months = GroupTable(spark, f"{root}/months", ("customer_id", "order_month"), month)
        self.customers = GroupTable(spark, f"{root}/customers", ("customer_id",), bucket)
        held = ("order_id", "product_id", "order_month")
        self.order_products = GroupTable(spark, f"{root}/order_products", held, month)
        bucket = F.pmod(F.xxhash64("product_id"), F.lit(CUSTOMER_PARTS))
        self.products = GroupTable(spark, f"{root}/products", ("product_id",), bucket)
        self.ranking = RankedValues(spark, f"{root}/ranking", CENTS)

    def load(self, models: Models) -> None:
        """Store everything anew."""
        self.facts.replace(models.order_facts_by_category)
        facts = self.facts.read()
        first = facts.withColumn("sign", F.lit(1))
        for table, differences in (
            (self.stores, store_differences(first)),
            (self.categories, category_differences(first)),
        ):
            table.replace(_summed(differences, table.keys))
        self.months.replace(customer_months(facts))
        self.customers.replace(customers(self.months.read()))
        if not self.ranked:
            return
        self.order_products.replace(models.order_products)
        sold = self.order_products.read().withColumn("sign", F.lit(1))
        self.products.replace(_summed(product_differences(sold), self.products.keys))
        self.ranking.load(self.products.read().select(_shown("cents")), "cents")

    def apply(self, models: Models, changed: DataFrame) -> None:
        """Take over orders that are new, changed, gone, or have changed lines.

        ``changed`` has their order_id, ``models`` the sources as they are now. Orders
        that the sources no longer have are deleted.
        """
        with temporary_tables(self.spark):
            ids = keep(changed.select("order_id").where("order_id IS NOT NULL").distinct(), "ids")
            batch = keep(models.for_order_ids(ids).order_facts_by_category, "facts")
            removed = ids.join(batch, "order_id", "left_anti")
            changes = keep(self.facts.signed_changes(batch, removed), "signed")
            self.facts.merge(batch, removed, stored=True)
            self.stores.add(store_differences(changes))
            self.categories.add(category_differences(changes))
            touched = keep(
                changes.select("customer_id", month_of(F.col("order_date")).alias("order_month")).distinct(),
                "touched",
            )
            self.months.put(touched, customer_months(self._facts_of(touched)))
            buyers = touched.select("customer_id").distinct()
            self.customers.put(buyers, customers(_of_groups(self.months.read(), buyers)))

            if self.ranked:
                self._apply_products(models.for_order_ids(ids), changes)

    def _apply_products(self, batch: Models, changes: DataFrame) -> None:
        """Products of the changed orders, before and after, and the ranks that follow."""
        month = month_of(F.col("order_date")).alias("order_month")
        before = changes.where((F.col("sign") < 0) & _done()).select("order_id", month)
        old = _of_groups(self.order_products.read_parts_of(before), before)
        new = keep(batch.order_products, "new")
        signed = keep(
            old.withColumn("sign", F.lit(-1)).unionByName(new.withColumn("sign", F.lit(1))), "held"
        )
        # Orders are replaced as a whole.
        self.order_products.put(before.unionAll(new.select(*before.columns)).distinct(), new)
        named = signed.select("product_id").distinct()
        values = [_shown("cents").alias("value")]
        left = keep(self.products.read_groups(named).select(*values, F.lit(-1).alias("n")), "left")
        self.products.add(product_differences(signed))
        came = self.products.read_groups(named).select(*values, F.lit(1).alias("n"))
        self.ranking.add(left.unionAll(came).select("value", F.col("n").cast("bigint")))

    def _facts_of(self, touched: DataFrame) -> DataFrame:
        """Stored facts of some customers' months, from the files of these months alone."""
        state = self.facts._state(self.facts._version())
        names = self.facts._month_names(touched.select(year_month(F.col("order_month"))))
        months = self.facts._read_months(state, [m for m in state["months"] if m in names])
        return _of_groups(
            months.withColumn("order_month", month_of(F.col("order_date"))), touched
        )

    # The marts as they are shown

    def revenue_by_store(self, models: Models) -> DataFrame:
        sums = self.stores.read().select("store_id", "order_month", _shown("cents"), "order_count")
        return marts.store_months(sums, models.stg_stores)

    def revenue_by_category(self, models: Models) -> DataFrame:
        sums = self.categories.read().select(
            "category_id", "order_month", _shown("cents"),
            _shown("units").alias("units_sold"), "order_count",
        )
        return marts.category_months(sums, models.stg_categories)

    def top_products(self, models: Models) -> DataFrame:
        return self._ranked_products(models, self.ranking.ranks())

    def best_products(self, models: Models, ranks: int) -> DataFrame:
        """Products on the first ranks; only the highest ranges of the ranking are read."""
        return self._ranked_products(models, self.ranking.best(ranks))

    def _ranked_products(self, models: Models, ranks: DataFrame) -> DataFrame:
        sums = self.products.read().select(
            "product_id", _shown("cents"), _shown("units").alias("units_sold"), "order_count"
        )
        sales = marts.product_totals(sums, models.product_dim)
        ranked = sales.join(ranks, F.col("cents").eqNullSafe(F.col("value")))
        return ranked.select(
            *[c for c in sales.columns if c != "cents"], F.col("dense_rank").alias("revenue_rank")
        )

    def customer_summary(self, models: Models) -> DataFrame:
        return marts.customer_totals(self.customers.read(), models.stg_customers)


def _of_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows whose values are in ``groups``, missing ones included."""
    named = groups.select(*[F.col(c).alias(f"_{c}") for c in groups.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in groups.columns]
    return rows.join(named, same, "left_semi")
