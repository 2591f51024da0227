"""Order updates as a stream into the stored order history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.operators.tables import SEQUENCE, MonthlyTable
from martloom.plans.descriptions import described
from martloom.plans.models import Models
from martloom.session import keep, temporary_tables
from martloom.sources.tables import with_tables


def newest_per_key(updates: DataFrame, key: str, sequence: str) -> DataFrame:
    """The last update of each key; updates are reduced before they are shuffled."""
    others = [c for c in updates.columns if c != sequence]
    newest = updates.groupBy(F.col(key).alias("update_key")).agg(
        F.max(F.struct(sequence, *others)).alias("newest")
    )
    return newest.select("newest.*").select(*updates.columns)


def start_order_feed(
    updates: DataFrame,
    sources: Mapping[str, DataFrame],
    table: MonthlyTable,
    checkpoint: str,
    sequence: str = "updated_at",
    order_totals: DataFrame | None = None,
) -> StreamingQuery:
    """Upsert a stream of raw order rows into ``table`` and stop when it is read.

    ``updates`` has the columns of the orders source and a ``sequence`` column that
    grows with each change of an order. The table keeps it, so that an update which
    arrives late never replaces a newer one. A batch that is delivered again after a
    failure replaces its own rows, so the table ends the same.

    ``order_totals`` are stored totals by order, as ``Models.order_totals`` has them. With
    them a batch reads no order lines; without, it reads all lines for its own orders.
    """

    def apply(batch: DataFrame, _: int) -> None:
        with temporary_tables(batch.sparkSession):
            latest = keep(newest_per_key(batch, "order_id", sequence), "updates")
            changed = with_tables(sources, orders=latest.drop(sequence))
            if order_totals is None:
                models = Models(changed).for_orders(F.lit(True))
            else:
                models = Models(changed, order_totals)
            numbers = latest.select("order_id", F.col(sequence).alias(SEQUENCE))
            rows = described("orders", models.orders_with(numbers))
            if table.exists():
                table.merge(rows)
            else:
                table.replace(rows)

    return (
        updates.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
