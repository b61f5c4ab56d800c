import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.segments import customer_activity, customer_segments, discrete_quantiles


def brute(values, fraction):
    values = sorted(v for v in values if v is not None)
    import math

    return values[max(math.ceil(len(values) * fraction), 1) - 1]


@pytest.mark.parametrize("seed", range(4))
def test_quantiles_against_sorting(spark, seed):
    rng = random.Random(seed)
    a = [rng.choice([-5.5, 0.0, 1e9, None] + [rng.uniform(-100, 100)] * 3) for _ in range(500)]
    b = [1.0 if rng.random() < 0.4 else float(rng.randrange(1000)) for _ in range(500)]  # hot value
    df = spark.createDataFrame(list(zip(a, b, strict=True)), "a double, b double").repartition(5)
    fractions = [0.25, 0.5, 0.75, 1.0]
    row = discrete_quantiles(df, ["a", "b"], fractions).first()
    assert row["a"] == [brute(a, q) for q in fractions]
    assert row["b"] == [brute(b, q) for q in fractions]


def test_segments(orders):
    rows = [
        (f"o{c}{i}", f"c{c}", "p", 1, float(c), f"2024-01-{c:02d}", "s")
        for c in range(1, 5)
        for i in range(c)
    ]
    activity = customer_activity(orders(rows))
    got = customer_segments(activity, F.lit("2024-02-01").cast("date")).orderBy("customer_id").collect()
    assert [r["frequency_band"] for r in got] == [1, 2, 3, 4]
    assert [r["monetary_band"] for r in got] == [1, 2, 3, 4]
    assert [r["recency_band"] for r in got] == [4, 3, 2, 1]


def test_equal_values_share_a_band(orders):
    rows = [(f"o{c}", f"c{c}", "p", 1, 5.0, "2024-01-01", "s") for c in range(9)]
    got = customer_segments(customer_activity(orders(rows)), F.lit("2024-02-01").cast("date"))
    assert {(r["recency_band"], r["frequency_band"], r["monetary_band"]) for r in got.collect()} == {
        (1, 1, 1)
    }
