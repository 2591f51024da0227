import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_support import rows_of

from martloom.llm import topk
SCHEMA = "vec_id bigint, embedding array<float>, block string, pivot int, beat double"


def brute(rows, k=5):
    whole = [
        (i, [math.floor(256 * x) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in whole if i % 50 == 0}:
        scored = sorted(
            (-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(b) == len(a)
        )
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


def ranked(spark, rows, schema=SCHEMA, **kwargs):
    frame = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], schema).repartition(3)
    vectors = frame.withColumn("vector", topk.quantised())
    got = rows_of(topk.search(vectors, F.col("vec_id") % 50 == 0, **kwargs))
    return [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got]


def run(spark, rows, **kwargs):
    return set(ranked(spark, rows, **kwargs))


@pytest.mark.parametrize("block_rows", [4, 1024])
def test_equals_brute_force(spark, monkeypatch, block_rows):
    """Clusters, ties, a vector held by a third of all rows, and vectors that take no part."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", block_rows)
    rng = random.Random(5)
    point = lambda: [rng.gauss(0, 1) for _ in range(6)]
    centres = [point() for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)]) for i in range(300)]
    rows += [(i, [0.5] * 6) for i in range(300, 450)]
    rows = [(i, [round(x * 64) / 64 for x in v]) for i, v in rows]
    rows += [
        (450, None), (500, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (550, [float("nan")] * 6),
        (600, [float("inf")] * 6), (650, [1.0, 2.0]), (651, [2.0, 2.0]), (700, []), (None, [0.5] * 6),
    ]
    assert run(spark, rows, pivots=8) == brute(rows)


def test_few_rows_and_none(spark):
    assert run(spark, []) == set()
    assert run(spark, [(0, [1.0])]) == set()
    rows = [(0, [1.0]), (1, [2.0]), (2, [-1.0])]
    assert run(spark, rows) == brute(rows) and len(brute(rows)) == 2


def test_annuli_are_left_out(spark):
    """Far clusters are not read: the bound drops them."""
    rng = random.Random(6)
    rows = [
        (i, [100.0 * (i % 10 == j) + rng.gauss(0, 0.05) for j in range(10)]) for i in range(400)
    ]
    rows = [(i, [round(x * 64) / 64 for x in v]) for i, v in rows]
    assert run(spark, rows, pivots=40) == brute(rows)


def test_repeated_query_rows(spark):
    """Equal rows of one query are one query; unlike ones are ranked apart."""
    others = [(i, [float(i), 1.0]) for i in range(1, 8)]
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [-1.0, 0.0]), *others]
    got = ranked(spark, rows)
    # The candidates of 0 are both rows of 50; those of 50 are both rows of 0.
    assert sorted(g for g in got if g[0] == 0) == sorted(
        (0, n + 1, i, i * 65536) for n, i in enumerate((7, 6, 5, 4, 3))
    )
    up = [(50, n + 1, i, i * 65536) for n, i in enumerate((7, 6, 5, 4, 3))]
    down = [(50, n + 1, i, -max(i, 1) * 65536) for n, i in enumerate((0, 0, 1, 2, 3))]
    assert sorted(g for g in got if g[0] == 50) == sorted(up + down)


def test_products_beyond_exact_doubles(spark, monkeypatch):
    """Large components: exact to 64 bits, an error beyond."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    wide = SCHEMA.replace("array<float>", "array<double>")
    rng = random.Random(9)
    rows = [(i, [float(rng.randrange(-(2**21), 2**21)) for _ in range(4)]) for i in range(200)]
    rows += [(200 + i, [2.0**21 - j / 256 for j in range(i, i + 4)]) for i in range(40)]
    got = set(ranked(spark, rows, wide, pivots=8))
    assert got == brute(rows) and max(s for *_, s in got) > 2**53
    with pytest.raises(Exception, match="too large"):
        ranked(spark, [(0, [2.0**40]), (1, [2.0**40])], wide)


def clustered(count, dim, seed=7):
    """Vectors near four centres, of which a third is one and the same."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = [(i, [round((c + rng.gauss(0, 0.1)) * 64) / 64 for c in centres[i % 4]]) for i in range(count)]
    return [(i, [0.5] * dim if i % 3 == 0 else v) for i, v in rows]


def test_regions_and_lots_of_any_size(spark, monkeypatch):
    """Many regions with several lots each, some of them of two dimensions, and large components."""
    sizes = {"BLOCK_ROWS": 4, "REGION_BYTES": 700, "LOT_QUERIES": 2, "QUERY_ROWS": 2, "BOUNDS_AT_ONCE": 3}
    for name, size in sizes.items():
        monkeypatch.setattr(topk, name, size)
    rows = clustered(400, 5) + [(i + 400, v) for i, v in clustered(200, 3)]
    rows += [(700 + i, [1000.0 + i, -400.0, 1.0]) for i in range(60)]
    assert run(spark, rows, pivots=8) == brute(rows)


def test_nothing_that_grows_is_broadcast(spark):
    """Queries and blocks meet in tasks, whatever Spark takes their size to be."""
    frame = spark.createDataFrame([(*r, "x", 1, 0.5) for r in clustered(300, 6)], SCHEMA)
    vectors = frame.withColumn("vector", topk.quantised())
    found = topk.search(vectors, F.col("vec_id") % 50 == 0)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 30


def test_best_of_blocks_equal_the_best_of_all():
    rng = np.random.default_rng(11)
    asked, k = np.arange(40), 3
    ids = rng.permutation(np.r_[0:300, 0:20])
    scores = rng.integers(-3, 3, (40, len(ids)))
    scores[:5] = 1
    best = topk._Best(asked, np.full(40, -np.inf), k)
    for some in np.array_split(np.arange(len(ids)), 9):
        some = some[np.argsort(ids[some], kind="stable")]
        for rows in (asked[::2], asked[1::2]):
            best.add(rows, ids[some], scores[np.ix_(rows, some)])
    for q in asked:
        want = sorted((-s, i) for s, i in zip(scores[q], ids) if i != q)[:k]
        mine = best.rows == q
        assert list(zip(-best.scores[mine], best.ids[mine])) == want
