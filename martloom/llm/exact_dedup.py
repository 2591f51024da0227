"""Exact deduplication in two passes over a Bloom filter.

Texts are equal if they are identical without spaces and the control characters tab to
carriage return. The first pass reads the texts once and keeps a narrow table: a digest,
the length and the id of each. Its keys fill a filter that tells which of them may occur
twice. In the second pass the rows that do not pass straight through; only the others
are shuffled, grouped by their whole digest, and get the row that stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import repeats
from martloom.llm.tables import read_table
from martloom.session import keep

BLANKS = b" \t\n\x0b\x0c\r"

_DIGESTS = "row long, doc_id long, length long, digest binary"


def _digested(text: bytes | None) -> bytes:
    return hashlib.sha256((text or b"").translate(None, BLANKS)).digest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each text without blanks, and its length with them, in code points."""
    for batch in batches:
        texts = batch.column("text")
        found = [_digested(text) for text in texts.cast(pa.binary()).to_pylist()]
        length = pc.fill_null(pc.utf8_length(texts), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), length, pa.array(found, pa.binary())],
            names=["row", "doc_id", "length", "digest"],
        )


def _digest_table(docs: DataFrame) -> DataFrame:
    """One narrow row per row of ``docs``, written once: row, doc_id, length, digest, key."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text"
    )
    rows = texts.mapInArrow(_digests, _DIGESTS)
    return keep(rows.withColumn("key", F.xxhash64("digest")), "digests")


def _groups(some: DataFrame) -> DataFrame:
    """Size and staying row of every group of equal texts, written once.

    The smallest struct is the row that stays; it and the sizes are combined before the
    shuffle, so that a large group is a row per task.
    """
    order = F.struct(
        (-F.col("length")).alias("size"), F.isnull("doc_id").alias("unnamed"), "doc_id", "row"
    )
    best = some.groupBy("digest").agg(F.count("*").alias("group_size"), F.min(order).alias("best"))
    return keep(
        best.select(
            "digest",
            "group_size",
            F.col("best.doc_id").alias("keep_id"),
            F.col("best.row").alias("keep_row"),
            (-F.col("best.size")).alias("keep_length"),
        ),
        "groups",
    )


def copies(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of ``docs``.

    ``docs`` has doc_id and text. Of rows with equal texts the longest stays, then the
    one of the smallest doc_id; a missing doc_id counts as the largest, and of rows that
    agree in both one stays. Missing texts count as empty, and texts of blanks alone
    equal them. An empty table gives an empty result.
    """
    rows = _digest_table(docs)
    known = repeats.repeated_filter(rows.select("key"), rows.count())
    marked = keep(rows.withColumn("repeated", repeats.may_repeat(known, "key")), "marked")
    some = marked.where("repeated")
    groups = _groups(some)
    text_sha256 = F.lower(F.hex("digest")).alias("text_sha256")
    alone = marked.where("NOT repeated").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        text_sha256,
    )
    joined = some.select("row", "doc_id", "digest").join(groups, "digest")
    grouped = joined.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), text_sha256
    )
    return alone.unionAll(grouped)


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Texts that are surely single are not shuffled.
    """
    rows = _digest_table(docs)
    known = repeats.repeated_filter(rows.select("key"), rows.count())
    groups = _groups(rows.where(repeats.may_repeat(known, "key")))

    @F.pandas_udf("binary")
    def digested(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _digested((t or "").encode("utf-8", "surrogatepass")))

    told = docs.withColumn("__digest", digested("text")).withColumn("__key", F.xxhash64("__digest"))
    told = told.withColumn("__repeated", repeats.may_repeat(known, "__key"))
    stays = groups.select(
        F.col("digest").alias("__digest"),
        F.col("keep_id").alias("__keep_id"),
        F.col("keep_length").alias("__length"),
    )
    own = F.coalesce(F.length("text"), F.lit(0))
    best = (
        told.where("__repeated")
        .join(stays, "__digest")
        .where(F.col("doc_id").eqNullSafe(F.col("__keep_id")) & (own == F.col("__length")))
        .dropDuplicates(["__digest"])
    )
    return told.where("NOT __repeated").select(*docs.columns).unionAll(best.select(*docs.columns))


def op11_bloom_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return copies(read_table(spark, folder, "documents"))


def oracle_sql() -> str:
    return r"""
WITH texts AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS plain
  FROM documents
), ranked AS (
  SELECT doc_id, plain, count(*) OVER (PARTITION BY plain) AS group_size,
    first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place
  FROM texts WINDOW best AS (PARTITION BY plain ORDER BY n DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(plain) AS text_sha256 FROM ranked
"""
