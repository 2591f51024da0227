"""Reading the test tables, and carrying ids through pandas."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import configure

# Stands for a missing id inside pandas, where whole numbers have no missing value and
# large ones would lose digits as floats.
NO_ID = -(2**63)


# Texts are long: batches of the default size would take much of a worker's memory.
BATCH_ROWS, BATCH_BYTES = "2000", "16m"


def prepared(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepared(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def carried(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID)).alias(column)


def restored(rows: DataFrame, column: str = "doc_id") -> DataFrame:
    return rows.withColumn(column, F.nullif(F.col(column), F.lit(NO_ID)))


def filtered(rows: DataFrame, keeps: Callable[[list], list[bool]], column: str = "text") -> DataFrame:
    """Rows whose text ``keeps`` accepts, batch by batch, with all columns as they are."""

    def batches(frames):
        for batch in frames:
            yield batch.filter(pa.array(keeps(batch.column(column).to_pylist()), pa.bool_()))

    return rows.mapInArrow(batches, rows.schema)
