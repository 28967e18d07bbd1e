import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.functions.intervals import with_day_blocks, with_interval_blocks
from salesmart.functions.numbers import percent_of, round_double
from salesmart.functions.text import clean_str, empty_to_null


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


def test_clean_str_strips_space_separators_only(spark):
    cases = {
        " a ": "a",
        " SKU_OLD_001  ": "SKU_OLD_001",
        "  　Минск  ": "Минск",
        "a b": "a b",
        "\ta\n": "\ta\n",
        "   ": "",
        "": "",
    }
    for text, expected in cases.items():
        assert one(spark, clean_str(F.lit(text))) == expected
    assert one(spark, clean_str(F.lit(None).cast("string"))) is None


def test_empty_to_null(spark):
    assert one(spark, empty_to_null(F.lit("  "))) is None
    assert one(spark, empty_to_null(F.lit(" x"))) == "x"


def test_round_double_goes_by_the_double(spark):
    assert one(spark, round_double(F.lit(1.005), 2)) == 1.0
    assert one(spark, round_double(F.lit(-2.5), 0)) == -3.0
    assert one(spark, round_double(F.lit(2.125), 2)) == 2.13


def test_percent_is_null_without_a_plan(spark):
    assert one(spark, percent_of(F.lit(5), F.lit(0.0))) is None
    assert one(spark, percent_of(F.lit(5), F.lit(None).cast("double"))) is None
    assert one(spark, percent_of(F.lit(1), F.lit(3.0))) == 33.33


days = st.dates(dt.date(1990, 1, 1), dt.date(2040, 12, 31))


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    intervals=st.lists(st.tuples(days, st.none() | days), min_size=1, max_size=30),
    asked=st.lists(days, min_size=1, max_size=30, unique=True),
)
def test_blocks_join_each_day_to_its_intervals_once(spark, intervals, asked):
    numbered = [(i, a, b) for i, (a, b) in enumerate(intervals)]
    left = spark.createDataFrame(numbered, "id int, a date, b date")
    right = spark.createDataFrame([(d,) for d in asked], "d date")
    blocks = with_interval_blocks(left, F.col("a"), F.col("b"))
    found = with_day_blocks(right, F.col("d")).join(blocks, ["level", "block"]).select("id", "d")
    expected = [(i, d) for i, a, b in numbered for d in asked if a <= d and (b is None or d <= b)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_interval_blocks_are_few(spark):
    df = spark.createDataFrame(
        [(dt.date(1, 1, 1), None), (dt.date(1999, 12, 31), dt.date(9999, 12, 31))],
        "a date, b date",
    )
    assert with_interval_blocks(df, F.col("a"), F.col("b")).count() < 2 * 2 * 22
