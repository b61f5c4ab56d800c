import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import growth, money_mean, money_sum, money_text


def total(spark, values, partitions=4):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)
    return df.agg(money_sum("x").alias("s"), money_mean("x").alias("m")).first()


def test_small_amounts_are_not_cut(spark):
    assert total(spark, [0.00004] * 1000)["s"] == pytest.approx(0.04)


def test_large_amounts_do_not_overflow(spark):
    df = spark.range(20_000_000).select(F.lit(5e14).alias("x"))
    assert df.agg(money_sum("x")).first()[0] == pytest.approx(1e22)


@pytest.mark.parametrize("odd", [math.nan, math.inf, 1e300])
def test_odd_amounts(spark, odd):
    got = total(spark, [1.0, odd])["s"]
    assert math.isnan(got) if math.isnan(odd) else got == 1.0 + odd


def test_nulls_and_empty(spark):
    row = total(spark, [None, 2.5])
    assert (row["s"], row["m"]) == (2.5, 2.5)
    assert tuple(total(spark, [])) == (None, None)
    assert tuple(total(spark, [None])) == (None, None)


def test_window_sum(spark):
    df = spark.createDataFrame([(i, 0.1) for i in range(5)], "i int, x double")
    w = Window.orderBy("i").rowsBetween(-2, 0)
    got = [r[0] for r in df.select(money_sum("x", w)).collect()]
    assert got == pytest.approx([0.1, 0.2, 0.3, 0.3, 0.3])


def test_growth_guards_its_base(spark):
    df = spark.createDataFrame([(3.0, 2.0), (3.0, 0.0), (3.0, -1.0)], "a double, b double")
    assert [r[0] for r in df.select(growth(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 0.0]


def test_money_text(spark):
    assert spark.range(1).select(money_text(F.lit(1234567.891))).first()[0] == "1,234,567.89"
