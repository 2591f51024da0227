"""Ranks over a whole table without sending it through one task.

A window without a partition key runs in a single task. Here the distinct values are
range partitioned, ranked inside each range, and shifted by the totals of the ranges
before. Equal values are counted before they move, so a value held by a third of all
rows is one row in the ranking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martloom.session import fine_shuffles, keep


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written, in tasks whose size does not follow that of the lines behind it."""
    with fine_shuffles(df.sparkSession):
        return keep(df, name)


def _ordered(name: str, descending: bool) -> Column:
    return F.desc(name) if descending else F.asc(name)


def value_ranks(df: DataFrame, value: str, descending: bool = False) -> DataFrame:
    """One row per distinct value: its rows, and the values and rows ranked before it.

    Columns: ``value``, ``values_before``, ``values_total``, ``rows_before``,
    ``rows_total``. NULL is a value of its own, first in ascending and last in
    descending order.
    """
    counted = df.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))
    # The range number is written out before it is used: ranges are found by sampling,
    # and a stage that runs again must not number them differently.
    ranges = keep(
        counted.repartitionByRange(_ordered("value", descending)).withColumn(
            "range", F.spark_partition_id()
        ),
        "ranges",
    )
    # One row per range, so at most one per shuffle partition.
    so_far = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        ranges.groupBy("range")
        .agg(F.count("*").alias("range_values"), F.sum("n").alias("range_rows"))
        .select(
            "range",
            F.coalesce(F.sum("range_values").over(so_far), F.lit(0)).alias("values_start"),
            F.coalesce(F.sum("range_rows").over(so_far), F.lit(0)).alias("rows_start"),
            F.sum("range_rows").over(W.partitionBy()).alias("rows_total"),
            F.sum("range_values").over(W.partitionBy()).alias("values_total"),
        )
    )
    inside = W.partitionBy("range").orderBy(_ordered("value", descending))
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    return (
        ranges.select(
            "value",
            "range",
            F.row_number().over(inside).alias("position"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_inside"),
        )
        .join(F.broadcast(starts), "range")
        .select(
            "value",
            (F.col("values_start") + F.col("position") - 1).alias("values_before"),
            (F.col("rows_start") + F.col("rows_inside")).alias("rows_before"),
            "rows_total",
            "values_total",
        )
    )


def _attach(
    df: DataFrame, value: str, descending: bool, ranks: dict[str, Column], stored: bool
) -> DataFrame:
    """``df`` with ranks by its values. The rows are read twice, for the values and for the
    join, and are written first unless they are ``stored``."""
    df = df if stored else _kept(df, "ranked")
    ranked = value_ranks(df.select(value), value, descending)
    ranked = ranked.select("value", *[rank.alias(name) for name, rank in ranks.items()])
    joined = df.join(ranked, F.col(value).eqNullSafe(F.col("value")))
    return joined.select(*df.columns, *ranks)


def _dense() -> Column:
    return F.col("values_before") + 1


def _percent() -> Column:
    share = F.col("rows_before") / (F.col("rows_total") - 1)
    return F.when(F.col("rows_total") > 1, share).otherwise(F.lit(0.0))


def with_dense_rank(
    df: DataFrame, value: str, name: str, descending: bool = False, stored: bool = False
) -> DataFrame:
    """Add ``dense_rank`` over the whole table as a BIGINT column."""
    return _attach(df, value, descending, {name: _dense()}, stored)


def with_percent_rank(
    df: DataFrame, value: str, name: str, descending: bool = False, stored: bool = False
) -> DataFrame:
    """Add ``percent_rank`` over the whole table as a DOUBLE column."""
    return _attach(df, value, descending, {name: _percent()}, stored)


def with_both_ranks(
    df: DataFrame, value: str, dense: str, percent: str, stored: bool = False
) -> DataFrame:
    """Add ``dense``, from the largest value down, and ``percent``, from the smallest up.

    One ranking serves both: counted from above, a value has the place that is left by
    the values before it.
    """
    downwards = F.col("values_total") - F.col("values_before")
    return _attach(df, value, False, {dense: downwards, percent: _percent()}, stored)


def top_ranked(df: DataFrame, value: str, name: str, k: int) -> DataFrame:
    """Rows whose dense rank by ``value``, descending, is at most ``k``; ties all stay.

    Only the ``k`` largest distinct values are looked up, and they are broadcast. No job
    runs before the result is asked for.
    """
    best = (
        df.select(F.col(value).alias("value"))
        .distinct()
        .orderBy(F.desc("value"))
        .limit(k)
        .select("value", F.row_number().over(W.orderBy(F.desc("value"))).cast("bigint").alias(name))
    )
    joined = df.join(F.broadcast(best), F.col(value).eqNullSafe(F.col("value")))
    return joined.select(*df.columns, name)


def best_by_revenue(sales: DataFrame, ranks: int) -> DataFrame:
    """Products on the first ``ranks`` revenue ranks, with ``revenue_rank``.

    A stored ranking is filtered by the rank it has; other product frames are written,
    so that the lines behind them are summed once, and ranked.
    """
    if "revenue_rank" in sales.columns:
        return sales.where(F.col("revenue_rank") <= ranks)
    return top_ranked(_kept(sales, "sales"), "total_revenue", "revenue_rank", ranks)
