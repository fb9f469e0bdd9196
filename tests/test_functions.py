from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockledger.functions import exact_sum, months_from, percent, round_half_away, seasonal
from tests.rows import day, frame


def test_round_half_away_scales_in_binary(spark):
    rows = [(0.285,), (1.005,), (-2.5,), (2.5,), (-0.001,), (None,), (0.125,)]
    df = frame(spark, "x double", rows)
    got = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    assert got == [0.28, 1.0, -2.5, 2.5, 0.0, None, 0.13]
    assert str(got[4]) == "0.0"
    whole = [r[0] for r in df.select(round_half_away("x", 0)).collect()]
    assert whole == [0.0, 1.0, -3.0, 3.0, 0.0, None, 0.0]


def test_percent_of_nothing_is_null(spark):
    df = frame(spark, "a double, b double", [(1.0, 0.0), (1.0, None), (1.0, 8.0)])
    got = [r[0] for r in df.select(percent(F.col("a"), F.col("b"), 1)).collect()]
    assert got == [None, None, 12.5]


cents = st.integers(min_value=-(10**14), max_value=10**14)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), cents), min_size=1, max_size=40))
def test_exact_sum_of_cents(spark, amounts):
    df = frame(spark, "x double", [(None if a is None else a / 100,) for a in amounts])
    # what the doubles hold, to six places
    held = [
        Decimal(a / 100).quantize(Decimal("0.000001"), ROUND_HALF_UP)
        for a in amounts
        if a is not None
    ]
    got = df.agg(exact_sum("x")).first()[0]
    if not held:
        assert got is None
    else:
        assert abs(got - sum(held)) <= Decimal("0.001") * len(held)
        small = [a for a in amounts if a is not None and abs(a) < 10**11]
        if len(small) == len(held):
            assert got.quantize(Decimal("0.00000001")) == sum(Decimal(a) for a in small) / 100


def test_exact_sum_does_not_depend_on_order(spark):
    df = spark.range(0, 20000, 1, 16).select((F.col("id") * 0.01 - 70.77).alias("x"))
    one = df.agg(exact_sum("x")).first()[0]
    other = df.orderBy(F.desc("x")).coalesce(1).agg(exact_sum("x")).first()[0]
    assert one == other == Decimal("584500.00")


def test_exact_sum_of_many_large_amounts(spark):
    rows = spark.range(1_100_000).select(F.lit(8.9e12).alias("x"))
    assert rows.agg(exact_sum("x")).first()[0] == Decimal("9790000000000000000")
    df = frame(spark, "x double", [(1e17,), (5e17,), (-1e17,), (0.25,), (1e13,)])
    assert df.agg(exact_sum("x")).first()[0] == Decimal("500010000000000000.25")


def test_exact_sum_does_not_round_addends(spark):
    rows = spark.range(556_235).select((F.lit(1000.0) / 72).alias("x"))
    got = rows.agg(exact_sum("x")).first()[0]
    assert abs(got - 556_235 * Decimal(1000.0 / 72)) < Decimal("0.000001")
    drift = frame(spark, "x double", [(4e-7,)] * 12)
    assert abs(drift.agg(exact_sum("x")).first()[0] - Decimal("0.0000048")) < Decimal("1e-11")


def test_rounding_leaves_what_it_cannot_round(spark):
    values = [1e17, 5e17, -1e17, float("inf"), float("-inf"), float("nan"), 1e13 + 0.125, None]
    df = frame(spark, "x double", [(v,) for v in values])
    got = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    assert got[:5] == values[:5] and got[5] != got[5] and got[6] == 1e13 + 0.13 and got[7] is None


@pytest.mark.parametrize("amount", [float("nan"), float("inf"), -1e23])
def test_exact_sum_refuses_what_does_not_fit(spark, amount):
    df = frame(spark, "x double", [(1.0,), (amount,), (None,)])
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="not a number below"):
                df.agg(exact_sum("x")).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_months_from_counts_calendar_months(spark):
    df = frame(spark, "a date, b date", [(day("2024-11-30"), day("2025-02-01"))])
    assert df.select(months_from("a", "b")).first()[0] == 3


def test_seasonal_averages_to_one(spark):
    months = spark.sql(
        "select explode(sequence(date'2025-01-01', date'2025-12-01', interval 1 month)) m"
    )
    mean = months.agg(F.avg(seasonal("m", 0.12, -1.2))).first()[0]
    assert abs(mean - 1.0) < 1e-12
