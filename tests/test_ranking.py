import random

import pytest
from conftest import records
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martloom import session
from martloom.operators import ranking
from martloom.operators.ranking import (
    top_ranked,
    value_ranks,
    with_both_ranks,
    with_dense_rank,
    with_percent_rank,
)


@pytest.fixture
def many_ranges(spark):
    """Keep every shuffle partition, so that values fall into several ranges."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


@pytest.fixture(scope="module")
def values(spark):
    """A third of the rows share one value; some have none."""
    rng = random.Random(5)
    rows = [(i, 500 if i % 3 == 0 else rng.randrange(1000)) for i in range(3000)]
    rows += [(3000 + i, None) for i in range(7)]
    return spark.createDataFrame(rows, "id bigint, v bigint").withColumn(
        "v", F.col("v").cast("decimal(28,0)")
    )


@pytest.mark.parametrize("descending", [False, True])
def test_ranks_equal_the_window_functions(many_ranges, values, descending):
    order = W.orderBy(F.desc("v") if descending else F.asc("v"))
    dense = with_dense_rank(values, "v", "rank", descending)
    want = values.withColumn("rank", F.dense_rank().over(order).cast("bigint"))
    assert dense.dtypes == want.dtypes and records(dense) == records(want)
    percent = with_percent_rank(values, "v", "rank", descending)
    want = values.withColumn("rank", F.percent_rank().over(order))
    assert percent.dtypes == want.dtypes and records(percent) == records(want)


def test_values_spread_over_ranges(many_ranges, values):
    ranks = value_ranks(values, "v")
    assert ranks.count() == values.select("v").distinct().count()
    assert ranks.agg(F.max("rows_before")).first()[0] < values.count()


def test_one_row_and_no_rows(spark):
    one = spark.createDataFrame([(1, 5)], "id bigint, v bigint")
    assert records(with_percent_rank(one, "v", "rank")) == [(1, 5, 0.0)]
    assert records(with_dense_rank(one, "v", "rank")) == [(1, 5, 1)]
    assert with_dense_rank(one.where("id > 1"), "v", "rank").count() == 0


def test_top_ranked_keeps_ties(spark):
    rows = [(1, 9), (2, 9), (3, 8), (4, 7), (5, None)]
    df = spark.createDataFrame(rows, "id bigint, v bigint")
    assert records(top_ranked(df, "v", "rank", 2)) == [(1, 9, 1), (2, 9, 1), (3, 8, 2)]
    assert len(records(top_ranked(df, "v", "rank", 9))) == 5


def test_no_row_of_the_input_passes_a_single_task(values):
    """The only unpartitioned window sees one row per range, never input rows."""
    text = with_dense_rank(values, "v", "rank")._jdf.queryExecution().toString()
    plan = text[text.index("== Physical Plan ==") :]
    windows = [line for line in plan.splitlines() if " Window [" in line]
    single = [line for line in windows if "dense_rank" in line or "row_number" in line]
    assert single and all("[range#" in line for line in single)


def test_one_ranking_serves_both_ways(many_ranges, values):
    both = with_both_ranks(values, "v", "dense", "percent")
    want = values.select(
        "*",
        F.dense_rank().over(W.orderBy(F.desc("v"))).cast("bigint").alias("dense"),
        F.percent_rank().over(W.orderBy(F.asc("v"))).alias("percent"),
    )
    assert both.dtypes == want.dtypes and records(both) == records(want)


def test_top_values_run_no_job_and_write_nothing(spark, values, monkeypatch):
    from martloom.operators import ranking

    monkeypatch.setattr(ranking, "keep", None)
    assert top_ranked(values, "v", "rank", 3).count() > 0


def test_the_lines_behind_a_ranking_start_from_many_partitions(spark, monkeypatch):
    """So that a task does not grow with them; the session is as before afterwards."""
    seen, written = [], ranking.keep

    def noted(df, name="kept"):
        if name in ("ranked", "sales"):
            seen.append(spark.conf.get(session.INITIAL, None))
        return written(df, name)

    monkeypatch.setattr(ranking, "keep", noted)
    sales = spark.createDataFrame([(1, 2.0), (2, 5.0)], "product_id int, total_revenue double")
    assert records(ranking.best_by_revenue(sales, 1)) == [(2, 5.0, 1)]
    assert ranking.with_dense_rank(sales, "total_revenue", "r").count() == 2
    assert seen == [str(session.FINE)] * 2
    assert spark.conf.get(session.INITIAL, None) is None
    spark.conf.set(session.INITIAL, 7)
    try:
        ranking.best_by_revenue(sales, 1)
        assert spark.conf.get(session.INITIAL) == "7"
    finally:
        spark.conf.unset(session.INITIAL)
    assert seen[2:] == ["7"]
