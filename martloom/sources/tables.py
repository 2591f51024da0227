"""Source tables stored under their own names."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from martloom.session import configure

SOURCE_TABLES = (
    "customers",
    "orders",
    "order_items",
    "products",
    "stores",
    "staffs",
    "brands",
    "categories",
    "stocks",
)


class Sources(dict):
    """Source tables by name, each opened when it is first asked for."""

    def __init__(self, open_table: Callable[[str], DataFrame]):
        super().__init__()
        self._open_table = open_table

    def __missing__(self, name: str) -> DataFrame:
        if name not in SOURCE_TABLES:
            raise KeyError(name)
        self[name] = self._open_table(name)
        return self[name]


def with_tables(sources: Mapping[str, DataFrame], **tables: DataFrame) -> Mapping[str, DataFrame]:
    """``sources`` with some tables put in place of its own."""
    return ChainMap(tables, sources)


def read_tables(spark: SparkSession, base: str, fmt: str = "parquet") -> Sources:
    """Read the nine tables from ``<base>/<table>``. Sources are never written to."""
    configure(spark)
    return Sources(lambda name: spark.read.format(fmt).load(f"{base}/{name}"))


def catalog_tables(spark: SparkSession, database: str) -> Sources:
    """The nine tables of a catalog database."""
    configure(spark)
    return Sources(lambda name: spark.table(f"{database}.{name}"))
