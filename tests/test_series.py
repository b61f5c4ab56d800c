import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import forecast as fc
from ledgerline.operators import timeseries as ts
from ledgerline.schemas import FORECAST_COLUMNS, SUMMARY_COLUMNS
from ledgerline.suite.adapters import order_events


def brute_force(revenues, first):
    """The forecast, spelled out in plain Python."""
    days = [first + dt.timedelta(days=i) for i in range(len(revenues))]
    mean = statistics.fmean
    recent, ma_14 = mean(revenues[-7:]), mean(revenues[-14:])
    base = mean(revenues[:7])
    growth = (recent - base) / base if base > 0 else 0.0
    rows = []
    for step in range(1, 8):
        day = days[-1] + dt.timedelta(days=step)
        same = [r for d, r in zip(days, revenues, strict=True) if d.weekday() == day.weekday()]
        factor = mean(same) / mean(revenues) if same and mean(revenues) else 1.0
        ensemble = (
            recent * factor
            + recent * (1 + growth) * factor
            + (0.3 * recent + 0.7 * ma_14) * factor
        ) / 3
        rows.append((day, ensemble, factor))
    return rows


@pytest.mark.parametrize("length", [1, 6, 7, 8, 14, 30])
def test_forecast_against_plain_python(daily, length):
    first = dt.date(2024, 1, 1)
    revenues = [100.0 + (i * 37) % 53 + i for i in range(length)]
    rows = fc.revenue_forecast(daily(revenues, first)).orderBy("forecast_date").collect()
    want = brute_force(revenues, first)
    assert [r["forecast_date"].date() for r in rows] == [day for day, _, _ in want]
    for row, (day, ensemble, factor) in zip(rows, want, strict=True):
        assert row["forecast_revenue"] == pytest.approx(ensemble, abs=0.006)
        assert row["seasonality_factor"] == pytest.approx(factor, abs=0.0006)
        assert row["lower_bound"] == pytest.approx(ensemble * 0.85, abs=0.006)
        assert row["upper_bound"] == pytest.approx(ensemble * 1.15, abs=0.006)
        assert row["day_name"] == day.strftime("%A")
        assert row["day_of_week"] == day.isoweekday() % 7 + 1
        assert row["lower_bound"] <= row["forecast_revenue"] <= row["upper_bound"]


def test_sunday_is_named_sunday(daily):
    rows = fc.revenue_forecast(daily([1.0] * 7)).collect()
    assert {r["day_of_week"]: r["day_name"] for r in rows}[1] == "Sunday"


def test_unseen_weekday_has_factor_one(daily):
    rows = fc.revenue_forecast(daily([10.0, 20.0, 30.0])).orderBy("forecast_date").collect()
    assert [r["seasonality_factor"] for r in rows] == [1.0, 1.0, 1.0, 1.0, 0.5, 1.0, 1.5]


def test_growth_is_zero_without_a_positive_base(daily):
    assert ts.series_levels(daily([0.0] * 7 + [5.0] * 7)).first()["growth_rate"] == 0.0
    assert ts.series_levels(daily([3.0, 9.0])).first()["growth_rate"] == 0.0


def test_all_zero_history(daily):
    rows = fc.revenue_forecast(daily([0.0] * 9)).collect()
    assert {r["forecast_revenue"] for r in rows} == {0.0}


def test_empty_in_empty_out(daily):
    empty = daily([1.0]).filter("false")
    assert fc.revenue_forecast(empty).count() == 0
    assert fc.forecast_summary(fc.forecast_details(empty)).count() == 0
    assert ts.weekday_seasonality(empty).count() == 0
    assert fc.revenue_forecast(empty).columns == FORECAST_COLUMNS


def test_parameters(daily):
    details = fc.forecast_details(daily([10.0] * 14), horizon=3, alpha=0.5, band=0.5, confidence=0.5)
    rows = fc.forecast_rows(details).collect()
    assert len(rows) == 3
    assert (rows[0]["lower_bound"], rows[0]["upper_bound"]) == (5.0, 15.0)
    assert rows[0]["confidence_level"] == 0.5


def test_summary(daily):
    details = fc.forecast_details(daily([10.0] * 14))
    summary = fc.forecast_summary(details)
    assert summary.columns == SUMMARY_COLUMNS
    row = summary.first()
    assert row["total_forecasted_revenue"] == 70.0 and row["avg_daily_forecast"] == 10.0
    assert row["growth_rate_percent"] == 0.0
    assert row["forecast_period_start"] == dt.datetime(2024, 1, 15)
    assert row["forecast_period_end"] == dt.datetime(2024, 1, 21)


def test_weighted_factors_average_to_one(spark, sf_dir):
    seasons = ts.weekday_seasonality(ts.daily_revenue(order_events(spark, sf_dir)))
    mean = seasons.agg(
        F.sum(F.col("seasonality_factor") * F.col("sample_count")) / F.sum("sample_count")
    ).first()[0]
    assert mean == pytest.approx(1.0, rel=1e-12)


def test_single_samples_have_no_deviation(daily):
    rows = ts.weekday_seasonality(daily([1.0] * 7)).collect()
    assert [r["stddev_revenue"] for r in rows] == [None] * 7


def test_series_are_independent(spark, daily):
    a, b = daily([10.0] * 9), daily([3.0, 5.0, 9.0])
    both = a.withColumn("key", F.lit("a")).unionByName(b.withColumn("key", F.lit("b")))
    together = fc.revenue_forecast(both, ["key"])
    for key, alone in (("a", a), ("b", b)):
        got = together.filter(F.col("key") == key).drop("key").orderBy("forecast_date").collect()
        assert got == fc.revenue_forecast(alone).orderBy("forecast_date").collect()


def test_fill_gaps(spark, daily):
    days = daily([1.0, 2.0, 3.0, 4.0]).filter("revenue not in (2.0, 3.0)")
    rows = ts.fill_gaps(days).orderBy("order_date").collect()
    assert [r["revenue"] for r in rows] == [1.0, 0.0, 0.0, 4.0]
    assert [r["order_count"] for r in rows] == [1, 0, 0, 1]
    assert rows[1]["day_name"] == "Tuesday"


def test_weighted_moving_average(daily):
    rows = ts.weighted_moving_average(daily([7.0, 14.0])).orderBy("order_date").collect()
    assert [r["weighted_ma_7"] for r in rows] == [7.0, (14 * 7 + 7 * 6) / 13]


def test_week_over_week(daily):
    row = ts.week_over_week(daily([100.0] * 3 + [2.0] * 7 + [3.0] * 7)).first()
    assert tuple(row) == (3.0, 2.0, 0.5)


def test_actual_vs_forecast(daily):
    history = daily([10.0] * 14)
    actual = daily([10.0] * 14 + [10.0, 20.0])
    rows = fc.actual_vs_forecast(actual, fc.revenue_forecast(history)).orderBy("date").collect()
    assert len(rows) == 21
    assert rows[13]["outside_band"] is None
    assert (rows[14]["error"], rows[14]["outside_band"]) == (0.0, False)
    assert (rows[15]["error"], rows[15]["error_percent"], rows[15]["outside_band"]) == (10.0, 100.0, True)
    assert rows[16]["actual_revenue"] is None and rows[16]["outside_band"] is None


def test_created_at_is_one_value(daily):
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")
    seasons = ts.weekday_seasonality(daily([1.0] * 9), created_at=stamp)
    assert seasons.select("created_at").distinct().count() == 1


def test_ordered_series_and_weekdays(daily):
    days = daily([float(i) for i in range(20)])
    dates = [r["order_date"] for r in ts.ordered(days.repartition(5)).collect()]
    assert dates == sorted(dates)
    weekdays = ts.ordered(ts.weekday_seasonality(days)).collect()
    assert [r["day_of_week"] for r in weekdays] == [1, 2, 3, 4, 5, 6, 7]
