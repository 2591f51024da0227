"""The corpus pipeline: operators of ``martloom.llm`` applied to the documents in turn.

Every stage works on all rows that its predecessor kept and returns the columns of
``documents``; the last adds ``shard`` and ``slot``. Rows without text or letters go
with the first stage; rows without doc_id are no one's duplicate. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm import decontamination, language_id, mixing, neardup, sharding
from martloom.llm.tables import prepared, read_table
from martloom.session import keep, local_trial

# Part of the clean tokens that the mixture draws.
SAMPLE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is told from their text; other scripts and junk go."""
    return language_id.in_a_language(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest doc_id.

    Of rows that share doc_id and text one stays; a doc_id with several texts keeps them.
    """
    kept = neardup.near_duplicates(docs).where("kept").select("doc_id").distinct()
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.xxhash64(*docs.columns))
    first = (
        docs.join(kept, "doc_id", "left_semi")
        .withColumn("__row", F.row_number().over(same))
        .where("__row = 1")
    )
    return first.select(*docs.columns).unionAll(docs.where("doc_id IS NULL"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have the target shares of source, language and topic.

    ``SAMPLE`` of the tokens are drawn, rare values as far as they reach; what the targets
    lack is written to the shared folder.
    """
    dimensions = mixing.document_dimensions()
    rates, targets = mixing.cell_rates(docs, dimensions, size=SAMPLE)
    keep(mixing.lacks(rates, targets), "mixture-lacks")
    drawn = mixing.mix(docs, dimensions, rates=rates)
    return drawn.where("sampled").select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(docs, ["doc_id"])


def _stage(function: Callable) -> Callable:
    @wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(prepared(local_trial(spark)), docs, sf_dir)

    return stage


STAGES = [
    (function.__name__, _stage(function))
    for function in (language, deduplicated, decontaminated, mixed, sharded)
]

# Linear machines and local alignment have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage over all that the one before kept; written and read again in between."""
    docs = read_table(local_trial(spark), sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = keep(docs, name)
    return docs
