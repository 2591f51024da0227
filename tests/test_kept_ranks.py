"""Kept ranks against a new ranking after every change."""

import random

import pytest
from conftest import records
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martloom.operators import kept_ranks
from martloom.operators.kept_ranks import RankedValues


def ranked_anew(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "value bigint")
    counts = rows.groupBy("value").agg(F.count("*").alias("n"))
    order = W.orderBy(F.desc("value"))
    above = F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1))
    return counts.select(
        "value", "n", F.dense_rank().over(order).cast("bigint").alias("dense_rank"),
        F.coalesce(above, F.lit(0)).alias("rows_above"),
    )


def table(spark, tmp_path, values, ranges=8):
    kept = RankedValues(spark, str(tmp_path), "bigint", ranges=ranges)
    kept.load(spark.createDataFrame([(v,) for v in values], "v bigint"), "v")
    return kept


def change(spark, kept, rows):
    kept.add(spark.createDataFrame(rows, "value bigint, n bigint"))


def test_random_changes_equal_a_new_ranking(spark, tmp_path):
    rng = random.Random(4)
    # A third of the rows hold one value; some hold none.
    values = [7] * 30 + [None] * 5 + [rng.randrange(-50, 200) for _ in range(60)]
    kept = table(spark, tmp_path, values)
    assert records(kept.ranks()) == records(ranked_anew(spark, values))
    for _ in range(3):
        gone = rng.sample(range(len(values)), 25)
        rows = [(values[i], -1) for i in gone]
        values = [v for i, v in enumerate(values) if i not in gone]
        new = [rng.choice([None, 7, rng.randrange(-80, 300)]) for _ in range(20)]
        values += new
        change(spark, kept, rows + [(v, 1) for v in new])
        want = ranked_anew(spark, values)
        assert records(kept.ranks()) == records(want)
        assert records(kept.best(5)) == records(want.where("dense_rank <= 5"))
        asked = spark.createDataFrame([(7,), (None,), (1000,)], "value bigint")
        held = want.where("value = 7 OR value IS NULL")
        assert records(kept.ranks_of(asked)) == records(held)


def test_a_change_leaves_other_ranges_as_they_are(spark, tmp_path):
    kept = table(spark, tmp_path, range(400))
    before = kept._state(1)
    change(spark, kept, [(399, 2), (1000, 1)])
    after = kept._state(kept._version())
    changed = [p for p in after["parts"] if before["parts"].get(p) != after["parts"][p]]
    assert len(changed) == 1 < len(after["parts"])
    assert records(kept.ranks_of(spark.createDataFrame([(0,)], "value bigint"))) == [(0, 1, 401, 402)]
    # The best rank needs the highest range alone.
    files = kept.best(1).inputFiles()
    assert files and all(f"_part={changed[0]}" in name for name in files)


def test_ranges_are_cut_anew_when_one_grows(spark, tmp_path):
    kept = table(spark, tmp_path, range(32), ranges=16)
    change(spark, kept, [(v, 1) for v in range(1000, 1600)])
    sizes = [values for values, _ in kept._state(kept._version())["ranges"].values()]
    assert max(sizes) * len(sizes) <= kept_ranks.UNEVEN * sum(sizes)
    assert records(kept.ranks()) == records(ranked_anew(spark, [*range(32), *range(1000, 1600)]))


@pytest.mark.parametrize("values", [[], [None], [3], [3, 3, None]])
def test_few_values(spark, tmp_path, values):
    kept = table(spark, tmp_path, values)
    assert records(kept.ranks()) == records(ranked_anew(spark, values))
    change(spark, kept, [(None, 1), (5, 1)])
    assert records(kept.ranks()) == records(ranked_anew(spark, [*values, None, 5]))
    assert records(kept.best(1)) == [(5, 1, 1, 0)]
