import hashlib
from decimal import ROUND_HALF_UP, Decimal

from conftest import day
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.functions import columns, money


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_line_amounts_round_half_cents_up(spark):
    rows = [
        (1, 0.05, 0.1, 5),  # 0.045 -> 0.05
        (3, 19.99, 0.07, 5577),  # 55.7721
        (1, 2.5, 0.35, 163),  # 1.625 -> 1.63
        (2, 100.0, 0.0, 20000),
        (2, 100.0, 1.0, 0),
        (-1, 0.05, 0.1, -5),
        (1, 92_233_720_368.5477, 0.0, 9_223_372_036_855),  # the last one that just fits
        (10**6, 10.0**8, 0.5, 5 * 10**15),  # more than a BIGINT of ten-thousandths holds
        (None, 1.0, 0.0, None),
        (10, 99_999.99, 0.12345, 87_654_991),
        (3, 1000.0, 0.33333, 200_001),
        (100, 19.99995, 0.0, 200_000),  # 1,999.995 exactly
        (3, 1000.0, 1 / 3, 200_000),  # no decimal amount: as the DOUBLE it is
        (10**8, 0.123456, 0.0, 1_234_560_000),
    ]
    df = spark.createDataFrame(rows, "q bigint, p double, d double, want bigint")
    got = df.select(money.line_cents(F.col("q"), F.col("p"), F.col("d")).alias("x"), "want")
    assert [r.x for r in got.collect()] == [r[3] for r in rows]


@settings(max_examples=4, deadline=None, phases=[Phase.generate])
@given(
    st.lists(
        st.tuples(st.integers(0, 10**4), st.integers(0, 10**9), st.integers(0, 10**4)),
        min_size=50,
        max_size=200,
    )
)
def test_line_amounts_equal_exact_decimals(spark, lines):
    rows = [(q, p / 100, d / 10_000) for q, p, d in lines]
    df = spark.createDataFrame(rows, "q bigint, p double, d double")
    got = [r[0] for r in df.select(money.line_cents(F.col("q"), F.col("p"), F.col("d"))).collect()]
    want = [
        int((Decimal(q * p * (10_000 - d)) / 10_000).quantize(Decimal(1), ROUND_HALF_UP))
        for q, p, d in lines
    ]
    assert got == want


@settings(max_examples=4, deadline=None, phases=[Phase.generate])
@given(
    st.lists(
        st.tuples(st.integers(0, 10**5), st.integers(0, 10**12), st.integers(0, 10**8)),
        min_size=50,
        max_size=200,
    )
)
def test_eight_decimals_are_exact(spark, lines):
    rows = [(q, p / 10**8, d / 10**8) for q, p, d in lines]
    df = spark.createDataFrame(rows, "q bigint, p double, d double")
    got = [r[0] for r in df.select(money.line_cents(F.col("q"), F.col("p"), F.col("d"))).collect()]
    want = [
        int((Decimal(q * p * (10**8 - d)) / 10**14).quantize(Decimal(1), ROUND_HALF_UP))
        for q, p, d in lines
    ]
    assert got == want


def test_mean_and_percent(spark):
    df = spark.createDataFrame([(5, 2), (1001, 2), (-5, 2), (7, 0), (None, 3)], "c bigint, n bigint")
    got = df.select(money.mean_dollars(F.col("c").cast("decimal(28,0)"), F.col("n"))).collect()
    assert [r[0] for r in got] == [0.03, 5.01, -0.03, None, None]
    share = df.select(money.percent(F.col("c"), F.col("n"))).collect()
    assert [r[0] for r in share] == [250.0, 50050.0, -250.0, None, None]


def test_totals_do_not_overflow(spark):
    df = spark.range(16).select(money.wide(F.lit(9 * 10**17).cast("bigint")).alias("c"))
    assert int(df.agg(F.sum("c")).first()[0]) == 16 * 9 * 10**17 > 2**63


def test_safe_date(spark):
    texts = ["NULL", None, "2016-13-01", "2016-01-03", "2016-1-3", "2016", "2016-01-03 10:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(columns.safe_date(F.nullif("t", F.lit("NULL")))).collect()]
    assert got == [None, None, None, day("2016-01-03"), day("2016-01-03"), None, None]


def test_hash_pii(spark):
    want = hashlib.sha256(b"ann@x.org").hexdigest()
    assert one(spark, columns.hash_pii(F.lit("ann@x.org"))) == want
    assert one(spark, columns.hash_pii(F.lit(None))) is None
    assert one(spark, columns.hash_pii(F.lit(7))) == hashlib.sha256(b"7").hexdigest()


def test_as_bigint_rounds_fractions(spark):
    df = spark.createDataFrame([(1.5,), (2.4,), (-1.5,)], "x double")
    assert [r[0] for r in df.select(columns.as_bigint(df, "x")).collect()] == [2, 2, -2]


def test_delivery_flag(spark):
    rows = [("2016-01-01", -1), ("2016-01-01", 0), ("2016-01-01", 2), (None, None), ("2016-01-01", None)]
    df = spark.createDataFrame([(day(s), d) for s, d in rows], "s date, d bigint")
    got = [r[0] for r in df.select(columns.is_on_time(F.col("s"), F.col("d"))).collect()]
    assert got == [True, True, False, None, False]


def test_stock_levels(spark):
    rows = [(0, 0.9), (5, 0.8), (5, 0.5), (5, 0.49), (6, 0.9), (None, 0.9)]
    df = spark.createDataFrame(rows, "q int, p double")
    got = df.select(
        columns.stock_status(F.col("q"), "In stock"),
        columns.restock_priority(F.col("q"), F.col("p")),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Out of stock", "HIGH"),
        ("Low stock", "HIGH"),
        ("Low stock", "MEDIUM"),
        ("Low stock", "LOW"),
        ("In stock", None),
        ("In stock", None),
    ]


def test_surrogate_key_tells_where_a_part_is_missing(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("a", "", "b")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    assert df.select(columns.surrogate_key("x", "y", "z").alias("k")).distinct().count() == 3


def test_surrogate_key_is_never_null(spark):
    df = spark.range(1).select(columns.surrogate_key(F.lit(None).cast("string"), F.col("id")).alias("k"))
    assert not df.schema["k"].nullable and df.first().k > 0
