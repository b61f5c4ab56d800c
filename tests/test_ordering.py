import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import timeseries
from ledgerline.operators.distinct import DistinctStore, bitmaps, count_distinct, extended
from ledgerline.operators.ordering import numbered, ntile, over_blocks, running_totals


def pairs(seed=2, n=500, ties=40):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(ties)]), i) for i in range(n)]


def test_positions_in_a_whole_order(spark):
    rows = pairs()
    df = spark.createDataFrame(rows, "v int, id long").repartition(5)
    found = numbered(df, [F.col("v").asc_nulls_first(), F.col("id").asc()]).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r["v"], r["id"]) for r in sorted(found, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in found) == list(range(len(rows)))


def test_positions_within_groups(spark):
    rows = [(g, v) for g, v in pairs(ties=3)]
    df = spark.createDataFrame(rows, "g int, id long")
    found = numbered(df, [F.col("id").desc()], ["g"]).collect()
    for g in {r[0] for r in rows}:
        own = sorted((r["position"], r["id"]) for r in found if r["g"] == g)
        assert own == list(enumerate(sorted((i for x, i in rows if x == g), reverse=True)))


def test_one_value_is_spread_over_blocks(spark):
    placed = numbered(spark.range(0, 4000, 1, 8).select(F.lit(1).alias("v"), "id"), [F.col("v").asc()])
    assert sorted(r["position"] for r in placed.collect()) == list(range(4000))
    # ties are parted, so no task holds them all
    sizes = [len(p) for p in placed.rdd.glom().collect()]
    assert max(sizes) < 2000


@pytest.mark.parametrize("n", [0, 1, 3, 4, 10, 403])
def test_ntile_deals_as_sql_does(spark, n):
    df = spark.createDataFrame(pairs(n=n, ties=6), "v int, id long")
    order = [F.col("v").asc_nulls_first(), F.col("id").asc()]
    want = df.withColumn("band", F.ntile(4).over(Window.orderBy(*order))).collect()
    assert sorted(map(str, ntile(df, order, 4).collect())) == sorted(map(str, want))


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_windows_over_blocks_equal_plain_windows(spark, blocks):
    """Also where blocks are shorter than the frame."""
    df = spark.createDataFrame(pairs(n=90, ties=1000), "v int, id long")
    order = [F.col("id").asc()]

    def columns(w):
        return {
            "mean": F.avg("v").over(w.rowsBetween(-6, 0)),
            "next": F.lead("id", 2).over(w),
            "rows": F.count("*").over(w.rowsBetween(-3, 3)),
        }

    want = df.withColumns(columns(Window.orderBy(*order))).collect()
    found = over_blocks(df, order, columns, before=6, after=3, blocks=blocks)
    assert sorted(map(str, found.collect())) == sorted(map(str, want))


def test_windows_over_blocks_pass_no_single_task(spark):
    df = spark.createDataFrame(pairs(n=200), "v int, id long")
    found = over_blocks(df, [F.col("id").asc()], lambda w: {"x": F.sum("v").over(w.rowsBetween(-2, 0))}, before=2)
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()


def test_running_totals(spark):
    df = spark.createDataFrame(pairs(), "v int, id long")
    window = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("t", F.coalesce(F.sum("v").over(window), F.lit(0))).collect()
    found = running_totals(df, [F.col("id").asc()], "v", "t").collect()
    assert sorted(map(str, found)) == sorted(map(str, want))


def test_hours_without_rows_are_filled(spark):
    hours = spark.sql(
        "select timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, h) as t, h as n, 'x' as s "
        "from values (0), (1), (5), (30) as v(h)"
    )
    filled = {r["t"].hour + 24 * (r["t"].day - 1): (r["n"], r["s"]) for r in timeseries.fill_time_gaps(hours, "t", "1 hour", ["n"]).collect()}
    assert sorted(filled) == list(range(31))
    assert filled[5] == (5, "x") and filled[6] == (0, None) and sum(n for n, _ in filled.values()) == 36


def test_numbers_of_values_never_change(spark):
    def frame(values):
        return spark.createDataFrame([(v,) for v in values], "c string")

    first = extended(None, frame(["b", "a", None, "b"]), "c")
    assert {r["c"]: r["number"] for r in first.collect()} == {"a": 0, "b": 1}
    second = extended(first, frame(["0", "a", "z"]), "c")
    assert {r["c"]: r["number"] for r in second.collect()} == {"a": 0, "b": 1, "0": 2, "z": 3}


def test_bitmaps_of_many_buckets_count_exactly(spark):
    rows = spark.range(100_000).select((F.col("id") % 7).alias("g"), (F.col("id") % 70_001).cast("string").alias("c"))
    dictionary = extended(None, rows, "c")
    stored = bitmaps(rows, dictionary, "c", ["g"])
    found = {r["_key0"]: r["distinct_values"] for r in count_distinct(stored, [F.col("g")]).collect()}
    assert found == {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count_distinct("c").alias("n")).collect()}
    assert count_distinct(stored, []).first()["distinct_values"] == 70_001


def test_a_range_reads_only_bitmaps(spark, tmp_path):
    rows = [(f"c{i % 17}", f"2024-01-{1 + i % 28:02d}") for i in range(300)] + [(None, "2024-01-03")]
    orders = spark.createDataFrame(rows, "customer_id string, d string").selectExpr("customer_id", "cast(d as date) as order_date")
    store = DistinctStore(spark, str(tmp_path / "s"), "customer_id")
    store.add(orders.where("order_date < '2024-01-15'"), first=True)
    store.add(orders.where("order_date >= '2024-01-15'"))
    found = store.between("2024-01-10", "2024-01-20")
    assert found.first()[0] == len({c for c, d in rows if c and "2024-01-10" <= d <= "2024-01-20"})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "customer_id" not in plan and plan.count("FileScan") == 1 and "GreaterThanOrEqual(order_date" in plan
    assert store.between("2030-01-01", "2030-01-02").count() <= 1


def test_smoothing_of_one_and_of_no_day(spark, daily):
    from ledgerline.operators.forecast import smoothed_forecast

    assert smoothed_forecast(daily([])).count() == 0
    one = smoothed_forecast(daily([10.0])).collect()
    assert len(one) == 7 and {r["forecast_smoothed"] for r in one} == {10.0}
    steady = smoothed_forecast(daily([5.0] * 40)).collect()
    assert {r["forecast_smoothed"] for r in steady} == {5.0}
