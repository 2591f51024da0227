"""Reproducible shuffle into shards by a permutation of row numbers.

Rows get gapless numbers in the order of (doc_id, CRC-32 of the text, all columns). A
Feistel network permutes the numbers 0 to n - 1: it works on pairs (left, right) below
the rounded-up root of n, and walks on from results that are not below n. Position p
is slot p // shards of shard p % shards, so that shard counts are at most one apart,
and the place of any row can be computed from its number, n and the key alone.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.tables import read_table
from martloom.session import keep

PRIME = 2**31 - 1
ROUNDS = 6
SHARDS = 24
KEY = 20_240_229


def round_keys(key: int) -> list[tuple[int, int, int]]:
    """Factor, addend and second factor of every round."""
    random = np.random.default_rng(key)
    return [tuple(int(v) for v in random.integers(2**30, PRIME, 3)) for _ in range(ROUNDS)]


def permute(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """Images of ``numbers`` under the permutation of 0 to n - 1 that ``key`` selects."""
    side = isqrt(n - 1) + 1 if n else 1
    out = numbers.astype(np.int64, copy=True)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] // side, out[walking] % side
        for factor, addend, second in round_keys(key):
            mixed = (right * factor + addend) % PRIME
            mixed ^= mixed >> 13
            left, right = right, (left + mixed * second % PRIME) % side
        out[walking] = left * side + right
        walking = walking[out[walking] >= n]
    return out


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows``, written once, with gapless ``row_number`` from 0, and their count.

    Rows are range partitioned, and one more column spreads rows that are equal in
    ``order``, so that no value makes a partition large. The offset of a partition is
    the count of rows in those before; there is one offset per partition.
    """
    spark = rows.sparkSession
    by = [*order, F.xxhash64(*rows.columns), F.monotonically_increasing_id()]
    spread = rows.withColumns({f"__by{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(by)})
    names = [f"__by{i}" for i in range(len(by))]
    kept = keep(
        spread.repartitionByRange(*names)
        .sortWithinPartitions(*names)
        .drop(*names)
        .withColumn("__at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftrightunsigned("__at", 33)
    counts = kept.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts, total = [], 0
    for row in counts:
        starts.append((row["part"], total))
        total += row["count"]
    offsets = F.broadcast(spark.createDataFrame(starts, "__part long, __start long"))
    within = F.col("__at").bitwiseAND(F.lit(2**33 - 1))
    out = (
        kept.withColumn("__part", part)
        .join(offsets, "__part")
        .withColumn("row_number", F.col("__start") + within)
    )
    return out.select(*rows.columns, "row_number"), total


def shard_rows(rows: DataFrame, order: list[str], shards: int = SHARDS, key: int = KEY) -> DataFrame:
    """``rows`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0).

    Columns of these names are replaced. Missing values in ``order`` come first; rows
    that are equal in every column are interchangeable. An empty table gives an empty
    result.
    """
    given = [c for c in rows.columns if c not in ("shard", "slot", "row_number")]
    counted, n = numbered(rows.select(*given), order)

    @F.pandas_udf(T.LongType())
    def position(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), n, key))

    return counted.withColumn("__position", position("row_number")).select(
        *given,
        (F.col("__position") % shards).cast("int").alias("shard"),
        F.expr(f"__position div {shards}").alias("slot"),
    )


def op3_feistel_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document under the law ``rows``.

    ``size`` is the text's bytes in UTF-8 plus 8, a missing text has none. Equal texts
    need not meet: one group may hold a third of all rows, so no law on counts allows it.
    """
    text = F.coalesce("text", F.lit(""))
    rows = read_table(spark, folder, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return shard_rows(rows, ["doc_id", "text_crc32", "size"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def oracle_sql() -> str:
    """The same in SQL: the walk is recursive, CRC-32 goes byte by byte."""
    factors, addends, seconds = (list(v) for v in zip(*round_keys(KEY)))
    mixed = f"((x % side * {factors}[i] + {addends}[i]) % {PRIME})"
    step = (
        f"list_reduce(list_concat([x], range(1, {ROUNDS + 1})), lambda x, i: x % side * side"
        f" + (x // side + xor({mixed}, {mixed} >> 13) * {seconds}[i] % {PRIME}) % side)"
    )
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_concat([b], range(8)), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS entries
  FROM (SELECT unnest(range(256)) AS b)
), texts AS (
  SELECT doc_id, encode(coalesce(text, '')) AS bytes FROM documents
), digests AS (
  SELECT doc_id, octet_length(bytes) + 8 AS size,
    xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(bytes), '..'),
      lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM texts, crc_table
), walk AS (
  SELECT doc_id, size, text_crc32, n, side, {step} AS x
  FROM (
    SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS x,
      count(*) OVER () AS n, ceil(sqrt(count(*) OVER ()))::BIGINT AS side
    FROM digests
  )
  UNION ALL
  SELECT doc_id, size, text_crc32, n, side, {step} FROM walk WHERE x >= n
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law,
  (x % {SHARDS})::INTEGER AS shard, (x // {SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM walk WHERE x < n
"""
