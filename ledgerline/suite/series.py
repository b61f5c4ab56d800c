"""Daily series, seasonality and forecast queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import forecast as fc
from ledgerline.operators import timeseries as ts
from ledgerline.suite.adapters import order_events, order_headers, order_snapshot
from ledgerline.suite.registry import (
    EVENTS,
    HEADERS,
    SNAPSHOT,
    daily,
    mean,
    query,
    rounded,
    total,
)

CUTOFF = "2024-01-23"  # history for the back test ends here
SHORT = "2024-01-05"  # five days of history: two weekdays are never seen

EVENT_DAILY = f"with {EVENTS}, {daily('order_events')}"
HEADER_DAILY = f"with {HEADERS}, {daily('order_headers')}"

MOVING = f"""
  {mean("revenue", "over (order by order_date rows between 6 preceding and current row)")} as ma_7,
  {mean("revenue", "over (order by order_date rows between 13 preceding and current row)")} as ma_14,
  {mean("revenue", "over (order by order_date rows between 29 preceding and current row)")} as ma_30"""


def forecast_ctes(key: str = "") -> str:
    """CTEs from ``daily`` to ``forecast``; ``key`` names the series column, if any."""
    comma = f"{key}, " if key else ""
    part = f"partition by {key}" if key else ""
    same_series = f"and s.{key} = h.{key}" if key else ""
    by_date = f"over ({part} order by order_date rows between"
    return f"""
placed as (
  select *, row_number() over ({part} order by order_date) as rn,
    count(*) over ({part}) as n,
    {mean("revenue", f"{by_date} 6 preceding and current row)")} as ma_7,
    {mean("revenue", f"{by_date} 13 preceding and current row)")} as ma_14
  from daily),
levels as (
  select {comma} {mean("revenue")} as overall_avg,
    {mean("case when rn > n - 7 then revenue end")} as recent_avg,
    {mean("case when rn <= 7 then revenue end")} as first_avg,
    arg_max(ma_7, order_date) as ma_7, arg_max(ma_14, order_date) as ma_14,
    max(order_date) as last_date
  from placed {f"group by {key}" if key else ""}),
grown as (
  select *, case when first_avg > 0 then (recent_avg - first_avg) / first_avg
                 else 0.0::double end as growth_rate from levels),
seasonality as (
  select {comma} day_of_week, {mean("revenue")} as weekday_avg from daily
  group by {comma} day_of_week),
horizon as (
  select g.*, cast(last_date + to_days(cast(step as integer)) as timestamp) as forecast_date
  from grown g, range(1, 8) as r(step) where last_date is not null),
days as (
  select h.*, cast(dayofweek(forecast_date) + 1 as integer) as day_of_week,
    dayname(forecast_date) as day_name,
    coalesce(case when h.overall_avg <> 0 then s.weekday_avg / h.overall_avg end, 1.0::double)
      as factor
  from horizon h left join seasonality s
    on s.day_of_week = dayofweek(forecast_date) + 1 {same_series}),
methods as (
  select *, ma_7 * factor as m1, ma_7 * (1.0::double + growth_rate) * factor as m2,
    (0.3::double * recent_avg + 0.7::double * ma_14) * factor as m3 from days),
ensemble as (select *, (m1 + m2 + m3) / 3.0::double as e from methods),
forecast as (
  select {comma} forecast_date, day_of_week, day_name,
    {rounded("e")} as forecast_revenue, {rounded("m1")} as forecast_ma,
    {rounded("m2")} as forecast_wma, {rounded("m3")} as forecast_es,
    {rounded("e * 0.85::double")} as lower_bound, {rounded("e * 1.15::double")} as upper_bound,
    {rounded("factor", 3)} as seasonality_factor, 0.85::double as confidence_level,
    recent_avg, ma_14, growth_rate
  from ensemble)"""


FORECAST = "select * exclude (recent_avg, ma_14, growth_rate) from forecast"

SUMMARY = f"""
  min(forecast_date) as forecast_period_start, max(forecast_date) as forecast_period_end,
  {rounded(total("forecast_revenue"))} as total_forecasted_revenue,
  {rounded(mean("forecast_revenue"))} as avg_daily_forecast,
  {rounded("max(recent_avg)")} as historical_avg_7d,
  {rounded("max(ma_14)")} as historical_avg_14d,
  {rounded("max(growth_rate) * 100.0::double")} as growth_rate_percent,
  'Ensemble (MA + WMA + ES)' as forecast_method, max(confidence_level) as confidence_level"""


def event_days(spark, sf):
    return ts.daily_revenue(order_events(spark, sf))


def header_days(spark, sf):
    return ts.daily_revenue(order_headers(spark, sf))


def days_until(daily_frame, date):
    return daily_frame.filter(F.col("order_date") <= F.lit(date).cast("timestamp"))


# -- daily series --------------------------------------------------------------------------------


@query("a7_daily_revenue", f"{EVENT_DAILY} select * from daily")
def a7(spark, sf):
    return event_days(spark, sf)


@query("a7_daily_revenue_with_gaps", f"{HEADER_DAILY} select * from daily")
def a7_gaps(spark, sf):
    return header_days(spark, sf)


@query(
    "a7_daily_revenue_per_product",
    f"with {SNAPSHOT}, {daily('snapshot', keys='product_id,')} select * from daily",
)
def a7_product(spark, sf):
    return ts.daily_revenue(order_snapshot(spark, sf), ["product_id"])


@query(
    "fill_gaps",
    f"""{HEADER_DAILY},
calendar as (select unnest(generate_series(min(order_date), max(order_date), interval 1 day))
  as order_date from daily)
select c.order_date, coalesce(revenue, 0.0::double) as revenue,
  coalesce(order_count, 0) as order_count, avg_order_value,
  cast(dayofweek(c.order_date) + 1 as integer) as day_of_week, dayname(c.order_date) as day_name
from calendar c left join daily d on c.order_date = d.order_date""",
)
def fill_gaps(spark, sf):
    return ts.fill_gaps(header_days(spark, sf))


@query("w1_w2_w3_moving_averages", f"{EVENT_DAILY} select *, {MOVING} from daily")
def w123(spark, sf):
    return ts.moving_averages(event_days(spark, sf))


@query("w1_w2_w3_moving_averages_with_gaps", f"{HEADER_DAILY} select *, {MOVING} from daily")
def w123_gaps(spark, sf):
    return ts.moving_averages(header_days(spark, sf))


@query(
    "c8_weighted_moving_average",
    f"""{HEADER_DAILY}, l as (select order_date, revenue,
  {", ".join(f"lag(revenue, {i}) over (order by order_date) as l{i}" for i in range(7))} from daily)
select order_date, revenue,
  (0.0::double + {" + ".join(f"coalesce(l{i} * {7 - i}.0::double, 0.0::double)" for i in range(7))})
  / ({" + ".join(f"case when l{i} is null then 0.0::double else {7 - i}.0::double end"
                 for i in range(7))}) as weighted_ma_7
from l""",
)
def c8(spark, sf):
    return ts.weighted_moving_average(header_days(spark, sf).select("order_date", "revenue"))


# -- seasonality and levels ----------------------------------------------------------------------


@query(
    "a8_t2_weekday_seasonality",
    f"""{EVENT_DAILY}
select day_of_week, day_name, {mean("revenue")} as avg_revenue,
  round(stddev_samp(revenue), 4) as stddev_revenue, count(order_date) as sample_count,
  {mean("revenue")} / (select {mean("revenue")} from daily) as seasonality_factor
from daily group by day_of_week, day_name""",
)
def a8(spark, sf):
    seasons = ts.weekday_seasonality(event_days(spark, sf))
    return seasons.withColumn("stddev_revenue", F.round("stddev_revenue", 4))


@query(
    "a8_weekday_seasonality_single_samples",
    f"""{EVENT_DAILY}
select day_of_week, day_name, {mean("revenue")} as avg_revenue,
  round(stddev_samp(revenue), 4) as stddev_revenue, count(order_date) as sample_count,
  {mean("revenue")} / (select {mean("revenue")} from daily where order_date <= date '{SHORT}')
    as seasonality_factor
from daily where order_date <= date '{SHORT}' group by day_of_week, day_name""",
)
def a8_single(spark, sf):
    seasons = ts.weekday_seasonality(days_until(event_days(spark, sf), SHORT))
    return seasons.withColumn("stddev_revenue", F.round("stddev_revenue", 4))


@query("t1_overall_daily_mean", f"{EVENT_DAILY} select {mean('revenue')} as overall_avg from daily")
def t1(spark, sf):
    return ts.overall_daily_mean(event_days(spark, sf))


LEVELS = "overall_avg, recent_avg, first_avg, ma_7, ma_14, last_date, growth_rate"


@query(
    "a11_g6_t3_t4_series_levels",
    f"{EVENT_DAILY}, {forecast_ctes()} select {LEVELS} from grown",
)
def levels(spark, sf):
    return ts.series_levels(event_days(spark, sf)).drop("weekday_factors")


@query(
    "t3_t4_series_levels_with_gaps",
    f"{HEADER_DAILY}, {forecast_ctes()} select {LEVELS} from grown",
)
def levels_gaps(spark, sf):
    return ts.series_levels(header_days(spark, sf)).drop("weekday_factors")


@query(
    "t3_t4_series_levels_per_product",
    f"with {SNAPSHOT}, {daily('snapshot', keys='product_id,')}, {forecast_ctes('product_id')} "
    f"select product_id, {LEVELS} from grown",
)
def levels_product(spark, sf):
    days = ts.daily_revenue(order_snapshot(spark, sf), ["product_id"])
    return ts.series_levels(days, ["product_id"]).drop("weekday_factors")


@query(
    "g4_first_and_last_days",
    f"""{HEADER_DAILY}, p as (select *, row_number() over (order by order_date) as rn,
  count(*) over () as n from daily)
select * exclude (rn, n), rn <= 7 as is_first, rn > n - 7 as is_last from p
where rn <= 7 or rn > n - 7""",
)
def g4(spark, sf):
    return ts.first_and_last_days(header_days(spark, sf))


@query(
    "c9_week_over_week",
    f"""{HEADER_DAILY}, p as (select *, row_number() over (order by order_date desc) as age
  from daily),
w as (select {mean("case when age <= 7 then revenue end")} as this_week_avg,
  {mean("case when age between 8 and 14 then revenue end")} as previous_week_avg from p)
select *, case when previous_week_avg > 0
  then (this_week_avg - previous_week_avg) / previous_week_avg
  else 0.0::double end as wow_growth_rate from w""",
)
def c9(spark, sf):
    return ts.week_over_week(header_days(spark, sf))


# -- forecast ------------------------------------------------------------------------------------


@query(
    "j1_j3_horizon_with_factors",
    f"{EVENT_DAILY}, {forecast_ctes()} select forecast_date, day_of_week, day_name, factor from days",
)
def j1(spark, sf):
    days = fc.horizon_days(ts.series_levels(event_days(spark, sf)))
    return days.select("forecast_date", "day_of_week", "day_name", "factor")


@query(
    "j1_factor_of_unseen_weekday",
    f"with {EVENTS}, {daily('order_events', where=f'''where order_date <= date '{SHORT}' ''')}, "
    f"{forecast_ctes()} select forecast_date, day_of_week, day_name, factor from days",
)
def j1_unseen(spark, sf):
    days = fc.horizon_days(ts.series_levels(days_until(event_days(spark, sf), SHORT)))
    return days.select("forecast_date", "day_of_week", "day_name", "factor")


@query("t5_t10_revenue_forecast", f"{EVENT_DAILY}, {forecast_ctes()} {FORECAST}")
def t5_t10(spark, sf):
    return fc.revenue_forecast(event_days(spark, sf))


@query("t5_t10_revenue_forecast_with_gaps", f"{HEADER_DAILY}, {forecast_ctes()} {FORECAST}")
def t5_t10_gaps(spark, sf):
    return fc.revenue_forecast(header_days(spark, sf))


@query(
    "t5_t10_revenue_forecast_per_status",
    f"with {EVENTS}, {daily('order_events', keys='status,')}, {forecast_ctes('status')} {FORECAST}",
)
def t5_t10_status(spark, sf):
    days = ts.daily_revenue(order_events(spark, sf), ["status"])
    return fc.revenue_forecast(days, ["status"])


@query(
    "t5_t10_revenue_forecast_per_product",
    f"with {SNAPSHOT}, {daily('snapshot', keys='product_id,')}, {forecast_ctes('product_id')} "
    f"{FORECAST}",
)
def t5_t10_product(spark, sf):
    days = ts.daily_revenue(order_snapshot(spark, sf), ["product_id"])
    return fc.revenue_forecast(days, ["product_id"])


@query("t11_forecast_summary", f"{EVENT_DAILY}, {forecast_ctes()} select {SUMMARY} from forecast")
def t11(spark, sf):
    return fc.forecast_summary(fc.forecast_details(event_days(spark, sf)))


@query(
    "t11_forecast_summary_per_status",
    f"with {EVENTS}, {daily('order_events', keys='status,')}, {forecast_ctes('status')} "
    f"select status, {SUMMARY} from forecast group by status",
)
def t11_status(spark, sf):
    days = ts.daily_revenue(order_events(spark, sf), ["status"])
    return fc.forecast_summary(fc.forecast_details(days, ["status"]), ["status"])


@query(
    "c5_history_and_forecast",
    f"""{EVENT_DAILY}, {forecast_ctes()}
select order_date as date, revenue, cast(null as double) as lower_bound,
  cast(null as double) as upper_bound, 'history' as kind from daily
union all
select forecast_date, forecast_revenue, lower_bound, upper_bound, 'forecast' from forecast""",
)
def c5(spark, sf):
    days = event_days(spark, sf)
    return fc.history_and_forecast(days, fc.revenue_forecast(days))


@query(
    "c7_actual_vs_forecast",
    f"""with {EVENTS}, {daily("order_events", name="actual")},
{daily("order_events", where=f"where order_date <= date '{CUTOFF}'")}, {forecast_ctes()}
select coalesce(a.order_date, f.forecast_date) as date, a.revenue as actual_revenue,
  forecast_revenue, lower_bound, upper_bound,
  {rounded("a.revenue - forecast_revenue")} as error,
  {rounded("(a.revenue - forecast_revenue) * 100.0::double / forecast_revenue")} as error_percent,
  a.revenue < lower_bound or a.revenue > upper_bound as outside_band
from actual a full outer join forecast f on a.order_date = f.forecast_date""",
)
def c7(spark, sf):
    days = event_days(spark, sf)
    return fc.actual_vs_forecast(days, fc.revenue_forecast(days_until(days, CUTOFF)))
