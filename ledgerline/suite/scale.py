"""Queries of the operators for long series, exact ranks, mergeable counts and smoothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import forecast, segments, timeseries
from ledgerline.operators.distinct import DistinctStore, count_distinct
from ledgerline.operators.ordering import running_totals
from ledgerline.session import scratch_path
from ledgerline.suite.adapters import order_events, order_headers
from ledgerline.suite.registry import EVENTS, HEADERS, daily, mean, query, rounded, total
from ledgerline.suite.series import event_days

BY_EVENT = "order by order_timestamp, order_id"


def _events(spark, sf):
    return order_events(spark, sf).select("order_id", "order_timestamp", "total_amount")


def _in_time():
    return [F.col("order_timestamp").asc_nulls_first(), F.col("order_id").asc_nulls_first()]


@query(
    "w1_w2_w3_moving_averages_per_event",
    f"""with {EVENTS} select order_id, order_timestamp, total_amount,
  {mean("total_amount", f"over ({BY_EVENT} rows between 6 preceding and current row)")} as ma_7,
  {mean("total_amount", f"over ({BY_EVENT} rows between 13 preceding and current row)")} as ma_14,
  {mean("total_amount", f"over ({BY_EVENT} rows between 29 preceding and current row)")} as ma_30
from order_events""",
)
def w_long(spark, sf):
    """One series of all events, in blocks."""
    return timeseries.long_moving_averages(_events(spark, sf), _in_time(), "total_amount")


@query(
    "g4_running_revenue_per_event",
    f"""with {EVENTS} select order_id, order_timestamp, total_amount,
  {total("total_amount", f"over ({BY_EVENT} rows between unbounded preceding and current row)")} as revenue_so_far
from order_events""",
)
def running(spark, sf):
    return running_totals(_events(spark, sf), _in_time(), "total_amount", "revenue_so_far")


@query(
    "fill_gaps_hourly",
    f"""with {EVENTS}, hourly as (
  select date_trunc('hour', order_timestamp) as hour, {total("total_amount")} as revenue, count(*) as order_count
  from order_events where status = 'purchase' group by 1),
calendar as (select unnest(generate_series(min(hour), max(hour), interval 1 hour)) as hour from hourly)
select c.hour, coalesce(revenue, 0.0::double) as revenue, coalesce(order_count, 0) as order_count
from calendar c left join hourly using (hour)""",
)
def hourly(spark, sf):
    hours = (
        order_events(spark, sf)
        .where("status = 'purchase'")
        .groupBy(F.date_trunc("hour", "order_timestamp").alias("hour"))
        .agg(F.sum("total_amount").alias("revenue"), F.count("*").alias("order_count"))
    )
    return timeseries.fill_time_gaps(hours, "hour", "1 hour", ["revenue", "order_count"])


@query(
    "c10_customer_ntiles",
    f"""with {HEADERS}, activity as (
  select customer_id, max(order_date) as last_order_date, count(order_id) as frequency, {total("total_amount")} as spend
  from order_headers group by 1),
measured as (select *, date_diff('day', last_order_date, date '2002-01-01')::int as recency_days from activity)
select *, ntile(4) over (order by recency_days, customer_id)::int as recency_band,
  ntile(4) over (order by frequency, customer_id)::int as frequency_band,
  ntile(4) over (order by spend, customer_id)::int as monetary_band from measured""",
)
def ntiles(spark, sf):
    activity = segments.customer_activity(order_headers(spark, sf))
    return segments.customer_ntiles(activity, F.lit("2002-01-01").cast("date"))


def _customers(spark, sf):
    """Bitmaps of customers by date, the later years added to a store of the earlier ones."""
    store = DistinctStore(spark, scratch_path(spark, "customers"), "customer_id")
    orders = order_headers(spark, sf).select("customer_id", "order_date")
    store.add(orders.where("order_date < '1996-01-01'"), first=True)
    store.add(orders.where("order_date >= '1996-01-01'"))
    return store


@query(
    "a1_distinct_customers_by_month",
    f"""with {HEADERS} select date_trunc('month', order_date)::date as month, count(distinct customer_id) as customers
from order_headers group by 1""",
)
def by_month(spark, sf):
    """Distinct customers of months out of the bitmaps of their days."""
    found = count_distinct(_customers(spark, sf).days(), [F.trunc("order_date", "month")], "customers")
    return found.withColumnRenamed("_key0", "month")


@query(
    "c6_distinct_customers_of_a_range",
    f"""with {HEADERS} select count(distinct customer_id) as customers from order_headers
where order_date between date '1995-03-10' and date '1997-08-20'""",
)
def of_a_range(spark, sf):
    return _customers(spark, sf).between("1995-03-10", "1997-08-20", "customers")


def _smoothing(key: str = "") -> str:
    comma, part = (f"{key}, ", f"partition by {key}") if key else ("", "")
    same = f"and d.{key} = s.{key}" if key else ""
    return f"""
placed as (select *, row_number() over ({part} order by order_date) as rn from daily),
means as (select {comma} {mean("revenue")} as overall_avg, max(order_date) as last_date from daily {f"group by {key}" if key else ""}),
factors as (select {comma} day_of_week, {mean("revenue")} as weekday_avg from daily group by {comma} day_of_week),
rates as (select s.*, m.last_date, case when m.overall_avg <> 0 then s.weekday_avg / m.overall_avg end as factor
  from factors s join means m on true {f"and s.{key} = m.{key}" if key else ""}),
base as (select d.*, s.last_date, case when s.factor > 0 then d.revenue / s.factor else d.revenue end as x
  from placed d join rates s on d.day_of_week = s.day_of_week {same}),
recursive_level as (select {comma} rn, last_date, x as level from base where rn = 1
  union all
  select {", ".join([f"b.{key}"] if key else [])}{"," if key else ""} b.rn, b.last_date, 0.3::double * b.x + 0.7::double * l.level
  from base b join recursive_level l on b.rn = l.rn + 1 {f"and b.{key} = l.{key}" if key else ""}),
ended as (select {comma} last_date, arg_max(level, rn) as level from recursive_level group by {comma} last_date),
ahead as (select e.*, cast(last_date + to_days(cast(step as integer)) as timestamp) as forecast_date
  from ended e, range(1, 8) as r(step))
select {f"a.{key}," if key else ""} forecast_date, cast(dayofweek(forecast_date) + 1 as integer) as day_of_week,
  dayname(forecast_date) as day_name, {rounded("level * coalesce(s.factor, 1.0::double)")} as forecast_smoothed
from ahead a left join rates s on s.day_of_week = dayofweek(forecast_date) + 1 {f"and s.{key} = a.{key}" if key else ""}"""


@query("t7_exponential_smoothing", f"with recursive {EVENTS}, {daily('order_events')}, {_smoothing()}")
def smoothing(spark, sf):
    return forecast.smoothed_forecast(event_days(spark, sf))


@query(
    "t7_exponential_smoothing_per_status",
    f"with recursive {EVENTS}, {daily('order_events', keys='status,')}, {_smoothing('status')}",
)
def smoothing_per_status(spark, sf):
    return forecast.smoothed_forecast(timeseries.daily_revenue(order_events(spark, sf), ["status"]), ["status"])
