"""Seven-day ensemble forecast with fixed bands, as one plan over the daily series.

The method names are historical: ``forecast_wma`` scales the 7-row mean by the growth rate and is not
a weighted mean, ``forecast_es`` blends two means, and the band is a fixed share of the ensemble and
not a statistical interval.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import day_name, day_of_week, midnight, money_mean, money_sum
from ledgerline.operators.timeseries import exponential_levels, series_levels
from ledgerline.schemas import FORECAST_COLUMNS, FORECAST_METHOD, SUMMARY_COLUMNS

# fixed values: horizon in days, smoothing weight, half band width, stated confidence
HORIZON = 7
ALPHA = 0.3
BAND = 0.15
CONFIDENCE = 0.85


def horizon_days(levels: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """One row per series and day after its last date, with that weekday's factor (1.0 if unseen)."""
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_step")
    days = levels.select("*", steps).withColumn(
        "forecast_date", midnight(F.date_add("last_date", F.col("_step")))
    )
    weekday = day_of_week("forecast_date")
    factor = F.coalesce(F.element_at("weekday_factors", weekday), F.lit(1.0))
    return days.drop("_step").withColumns(
        {"day_of_week": weekday, "day_name": day_name("forecast_date"), "factor": factor}
    )


def forecast_details(
    daily: DataFrame,
    series_keys: Sequence[str] = (),
    horizon: int = HORIZON,
    alpha: float = ALPHA,
    band: float = BAND,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """Forecast rows, rounded last, next to the levels they come from."""
    days = horizon_days(series_levels(daily, series_keys), horizon)
    factor, ma_7 = F.col("factor"), F.col("ma_7")
    blend = F.lit(alpha) * F.col("recent_avg") + F.lit(1 - alpha) * F.col("ma_14")
    methods = days.withColumns(
        {
            "_ma": ma_7 * factor,
            "_wma": ma_7 * (F.lit(1.0) + F.col("growth_rate")) * factor,
            "_es": blend * factor,
        }
    ).withColumn("_ensemble", (F.col("_ma") + F.col("_wma") + F.col("_es")) / F.lit(3.0))
    return methods.select(
        *series_keys,
        "forecast_date",
        "day_of_week",
        "day_name",
        F.round("_ensemble", 2).alias("forecast_revenue"),
        F.round("_ma", 2).alias("forecast_ma"),
        F.round("_wma", 2).alias("forecast_wma"),
        F.round("_es", 2).alias("forecast_es"),
        F.round(F.col("_ensemble") * F.lit(1 - band), 2).alias("lower_bound"),
        F.round(F.col("_ensemble") * F.lit(1 + band), 2).alias("upper_bound"),
        F.round("factor", 3).alias("seasonality_factor"),
        F.lit(confidence).alias("confidence_level"),
        "recent_avg",
        "ma_14",
        "growth_rate",
    )


def forecast_rows(
    details: DataFrame, series_keys: Sequence[str] = (), created_at: Column | None = None
) -> DataFrame:
    """The forecast table of :func:`forecast_details`."""
    rows = details.select(*series_keys, *FORECAST_COLUMNS)
    return rows if created_at is None else rows.withColumn("created_at", created_at)


def forecast_summary(
    details: DataFrame,
    series_keys: Sequence[str] = (),
    method: str = FORECAST_METHOD,
    created_at: Column | None = None,
) -> DataFrame:
    """Period, total and mean of the rounded forecast, recent levels and growth; a row per series."""
    summary = details.groupBy(*series_keys).agg(
        F.min("forecast_date").alias("forecast_period_start"),
        F.max("forecast_date").alias("forecast_period_end"),
        F.round(money_sum("forecast_revenue"), 2).alias("total_forecasted_revenue"),
        F.round(money_mean("forecast_revenue"), 2).alias("avg_daily_forecast"),
        F.round(F.max("recent_avg"), 2).alias("historical_avg_7d"),
        F.round(F.max("ma_14"), 2).alias("historical_avg_14d"),
        F.round(F.max("growth_rate") * 100.0, 2).alias("growth_rate_percent"),
        F.max("confidence_level").alias("confidence_level"),
    )
    summary = (
        summary.filter(F.col("forecast_period_start").isNotNull())
        .withColumn("forecast_method", F.lit(method))
        .select(*series_keys, *SUMMARY_COLUMNS)
    )
    return summary if created_at is None else summary.withColumn("created_at", created_at)


def revenue_forecast(daily: DataFrame, series_keys: Sequence[str] = (), **options) -> DataFrame:
    """Forecast table of a daily series."""
    return forecast_rows(forecast_details(daily, series_keys, **options), series_keys)


def smoothed_forecast(
    daily: DataFrame, series_keys: Sequence[str] = (), horizon: int = HORIZON, alpha: float = ALPHA
) -> DataFrame:
    """The days ahead by exponential smoothing: the smoothed level times each weekday's factor."""
    days = horizon_days(exponential_levels(daily, series_keys, alpha), horizon)
    return days.select(
        *series_keys,
        "forecast_date",
        "day_of_week",
        "day_name",
        F.round(F.col("level") * F.col("factor"), 2).alias("forecast_smoothed"),
    )


def history_and_forecast(
    daily: DataFrame, forecast: DataFrame, series_keys: Sequence[str] = ()
) -> DataFrame:
    """History and forecast as one series; ``kind`` tells them apart, bands only on the forecast."""
    history = daily.select(
        *series_keys,
        F.col("order_date").alias("date"),
        "revenue",
        F.lit("history").alias("kind"),
    )
    future = forecast.select(
        *series_keys,
        F.col("forecast_date").alias("date"),
        F.col("forecast_revenue").alias("revenue"),
        "lower_bound",
        "upper_bound",
        F.lit("forecast").alias("kind"),
    )
    return history.unionByName(future, allowMissingColumns=True)


def actual_vs_forecast(
    daily: DataFrame, forecast: DataFrame, series_keys: Sequence[str] = ()
) -> DataFrame:
    """Actual next to forecast per date; error, percent error, and whether it left the band."""
    actual = daily.select(
        *series_keys, F.col("order_date").alias("date"), F.col("revenue").alias("actual_revenue")
    )
    expected = forecast.select(
        *series_keys,
        F.col("forecast_date").alias("date"),
        "forecast_revenue",
        "lower_bound",
        "upper_bound",
    )
    error = F.col("actual_revenue") - F.col("forecast_revenue")
    outside = (F.col("actual_revenue") < F.col("lower_bound")) | (
        F.col("actual_revenue") > F.col("upper_bound")
    )
    return (
        actual.join(expected, [*series_keys, "date"], "full_outer")
        .withColumn("error", F.round(error, 2))
        .withColumn(
            "error_percent", F.round(F.try_divide(error * 100.0, F.col("forecast_revenue")), 2)
        )
        .withColumn("outside_band", outside)
    )
