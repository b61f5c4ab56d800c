"""Metric queries: filters, totals, rankings, shares, trends, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import functions as fn
from ledgerline.operators import filters, metrics, quality, rollup, segments
from ledgerline.schemas import PREVIEW_COLUMNS
from ledgerline.suite.adapters import (
    ORDER_COLUMNS,
    order_events,
    order_headers,
    order_log,
    order_snapshot,
    table,
)
from ledgerline.suite.registry import (
    EVENTS,
    HEADERS,
    ORDER_LOG,
    SNAPSHOT,
    mean,
    query,
    rounded,
    total,
)

DAY = "2024-01-15"
EMPTY_DAY = "2030-01-01"
EVENT_STATUSES = ["signup", "view", "click", "error", "purchase"]

TOTALS = f"""
  count(order_id) as total_orders,
  {total("total_amount")} as total_revenue,
  {mean("total_amount")} as avg_order_value,
  min(total_amount) as min_order,
  max(total_amount) as max_order,
  count(distinct customer_id) as unique_customers,
  count(distinct product_id) as unique_products"""

SUMMARY = f"""
  count(*) as total_orders,
  {total("total_amount")} as total_revenue,
  {mean("total_amount")} as avg_order_value"""

PRODUCT_TOTALS = f"""
  select product_id, count(order_id) as order_count,
         {total("total_amount")} as total_revenue,
         {mean("total_amount")} as avg_revenue,
         cast(sum(quantity) as bigint) as total_quantity
  from snapshot group by product_id"""

CUSTOMER_TOTALS = f"""
  select customer_id, count(order_id) as order_count,
         {total("total_amount")} as total_spent,
         {mean("total_amount")} as avg_order_value
  from snapshot group by customer_id"""


# -- projections and filters ---------------------------------------------------------------------


@query(
    "p3_derived_amount",
    f"with {ORDER_LOG} select order_id, quantity, price, total_amount from order_log",
)
def p3(spark, sf):
    return order_log(spark, sf).select("order_id", "quantity", "price", "total_amount")


@query(
    "p6_run_date_label",
    f"with {EVENTS} select status, count(order_id) as count, '{DAY}' as processing_date "
    "from order_events group by status",
)
def p6(spark, sf):
    counts = metrics.status_totals(order_events(spark, sf)).select("status", "count")
    return filters.with_run_date(counts, DAY)


@query(
    "p7_column_subset",
    f"with {SNAPSHOT} select {', '.join(PREVIEW_COLUMNS)} from snapshot",
)
def p7(spark, sf):
    return order_snapshot(spark, sf).select(*PREVIEW_COLUMNS)


@query(
    "p8_date_filter",
    f"with {EVENTS} select * from order_events where order_date = date '{DAY}'",
)
def p8(spark, sf):
    return filters.on_date(order_events(spark, sf), DAY)


@query(
    "p10_fallback_to_all",
    f"with {EVENTS} select *, true as used_fallback from order_events",
)
def p10_all(spark, sf):
    return filters.on_date_or_all(order_events(spark, sf), EMPTY_DAY)


@query(
    "p10_fallback_not_needed",
    f"with {EVENTS} select *, false as used_fallback from order_events "
    f"where order_date = date '{DAY}'",
)
def p10_day(spark, sf):
    return filters.on_date_or_all(order_events(spark, sf), DAY)


@query(
    "k8_preview",
    f"with {SNAPSHOT} select {', '.join(PREVIEW_COLUMNS)} from snapshot order by order_id limit 10",
)
def k8(spark, sf):
    return filters.preview(order_snapshot(spark, sf), 10, PREVIEW_COLUMNS, ["order_id"])


# -- aggregates ----------------------------------------------------------------------------------


@query("a1_order_totals", f"with {SNAPSHOT} select {TOTALS} from snapshot")
def a1(spark, sf):
    return metrics.order_totals(order_snapshot(spark, sf))


@query(
    "a1_order_totals_of_day",
    f"with {EVENTS} select {TOTALS}, '{DAY}' as processing_date from order_events "
    f"where order_date = date '{DAY}'",
)
def a1_day(spark, sf):
    day = filters.on_date(order_events(spark, sf), DAY)
    return filters.with_run_date(metrics.order_totals(day), DAY)


@query(
    "a1_order_totals_of_empty_day",
    f"with {EVENTS} select {TOTALS}, '{EMPTY_DAY}' as processing_date from order_events "
    f"where order_date = date '{EMPTY_DAY}'",
)
def a1_empty(spark, sf):
    day = filters.on_date(order_events(spark, sf), EMPTY_DAY)
    return filters.with_run_date(metrics.order_totals(day), EMPTY_DAY)


@query("a2_order_summary", f"with {SNAPSHOT} select {SUMMARY} from snapshot")
def a2(spark, sf):
    return metrics.order_summary(order_snapshot(spark, sf))


@query("a3_product_totals", f"with {SNAPSHOT} {PRODUCT_TOTALS}")
def a3(spark, sf):
    return metrics.product_totals(order_snapshot(spark, sf))


@query("a4_customer_totals", f"with {SNAPSHOT} {CUSTOMER_TOTALS}")
def a4(spark, sf):
    return metrics.customer_totals(order_snapshot(spark, sf))


@query(
    "a5_status_totals",
    f"with {SNAPSHOT} select status, count(order_id) as count, {total('total_amount')} as revenue "
    "from snapshot group by status",
)
def a5(spark, sf):
    return metrics.status_totals(order_snapshot(spark, sf))


@query(
    "a6_hourly_totals",
    f"with {EVENTS} select cast(hour(order_timestamp) as integer) as hour, "
    f"count(order_id) as order_count, {total('total_amount')} as revenue "
    "from order_events group by 1",
)
def a6(spark, sf):
    return metrics.hourly_totals(order_events(spark, sf))


@query(
    "a9_status_counts",
    f"with {SNAPSHOT} select status, count(*) as count from snapshot group by status",
)
def a9(spark, sf):
    return metrics.status_counts(order_snapshot(spark, sf))


@query(
    "a10_product_revenue",
    f"with {SNAPSHOT} select product_id, count(order_id) as order_count, "
    f"{total('total_amount')} as revenue from snapshot group by product_id",
)
def a10(spark, sf):
    return metrics.product_revenue(order_snapshot(spark, sf))


@query("a12_row_count", f"with {SNAPSHOT} select count(*) as row_count from snapshot")
def a12(spark, sf):
    return metrics.row_count(order_snapshot(spark, sf))


# -- shares, rankings, trends --------------------------------------------------------------------


@query(
    "w4_status_distribution",
    f"with {SNAPSHOT} select status, count(order_id) as count, {total('total_amount')} as revenue, "
    f"{rounded('count(order_id) * 100.0::double / sum(count(order_id)) over ()')} as percentage "
    "from snapshot group by status",
)
def w4(spark, sf):
    return metrics.status_distribution(order_snapshot(spark, sf))


@query(
    "w4_customer_share_wide",
    f"with {SNAPSHOT} select customer_id, count(order_id) as order_count, "
    f"{rounded('count(order_id) * 100.0::double / sum(count(order_id)) over ()')} as percentage "
    "from snapshot group by customer_id",
)
def w4_wide(spark, sf):
    counts = metrics.customer_totals(order_snapshot(spark, sf)).select("customer_id", "order_count")
    return metrics.share_of_total(counts, "order_count")


@query(
    "g1_top_products",
    f"with {SNAPSHOT}, p as ({PRODUCT_TOTALS}) "
    "select * from p order by total_revenue desc, product_id limit 10",
)
def g1(spark, sf):
    return metrics.top(
        metrics.product_totals(order_snapshot(spark, sf)), "total_revenue", "product_id"
    )


@query(
    "g2_top_customers",
    f"with {SNAPSHOT}, c as ({CUSTOMER_TOTALS}) "
    "select * from c order by total_spent desc, customer_id limit 10",
)
def g2(spark, sf):
    return metrics.top(
        metrics.customer_totals(order_snapshot(spark, sf)), "total_spent", "customer_id"
    )


@query(
    "g3_top5_products",
    f"with {SNAPSHOT} select product_id, count(order_id) as order_count, "
    f"{total('total_amount')} as revenue from snapshot group by product_id "
    "order by revenue desc, product_id limit 5",
)
def g3(spark, sf):
    return metrics.top(
        metrics.product_revenue(order_snapshot(spark, sf)), "revenue", "product_id", 5
    )


@query("g5_latest_per_key", f"with {SNAPSHOT} select {', '.join(ORDER_COLUMNS)} from snapshot")
def g5(spark, sf):
    return order_snapshot(spark, sf)


@query(
    "g7_hourly_trends",
    f"with {EVENTS} select cast(hour(order_timestamp) as integer) as hour, "
    f"count(order_id) as order_count, {total('total_amount')} as revenue "
    "from order_events group by 1 order by 1",
)
def g7(spark, sf):
    return metrics.hourly_trends(order_events(spark, sf))


@query(
    "g8_status_by_count",
    f"with {SNAPSHOT} select status, count(*) as count from snapshot group by status "
    "order by count desc, status",
)
def g8(spark, sf):
    return metrics.status_counts(order_snapshot(spark, sf)).orderBy(
        F.col("count").desc(), "status"
    )


@query(
    "c4_hour_and_status_trend",
    f"with {EVENTS} select cast(hour(order_timestamp) as integer) as hour, status, "
    f"count(order_id) as order_count, {total('total_amount')} as revenue "
    "from order_events group by 1, 2",
)
def c4(spark, sf):
    return metrics.hourly_status_trend(order_events(spark, sf))


@query(
    "c4_hour_by_status_columns",
    f"with {EVENTS} select cast(hour(order_timestamp) as integer) as hour, "
    + ", ".join(f"count(order_id) filter (status = '{s}') as {s}_orders" for s in EVENT_STATUSES)
    + " from order_events group by 1",
)
def c4_columns(spark, sf):
    return metrics.hourly_status_trend(order_events(spark, sf), statuses=EVENT_STATUSES)


@query(
    "c6_metric_changes",
    f"""with {HEADERS}, h as (
  select order_date, count(order_id) as total_orders, {total("total_amount")} as total_revenue
  from order_headers group by order_date),
l as (select *, lag(total_orders) over (order by order_date) as po,
             lag(total_revenue) over (order by order_date) as pr from h)
select order_date, total_orders, po as previous_total_orders,
  total_orders - po as total_orders_change,
  {rounded("(total_orders - po) * 100.0::double / nullif(po, 0)")} as total_orders_change_percent,
  total_revenue, pr as previous_total_revenue, total_revenue - pr as total_revenue_change,
  {rounded("(total_revenue - pr) * 100.0::double / nullif(pr, 0)")} as total_revenue_change_percent
from l""",
)
def c6(spark, sf):
    history = order_headers(spark, sf).groupBy("order_date").agg(
        F.count("order_id").alias("total_orders"),
        fn.money_sum("total_amount").alias("total_revenue"),
    )
    return metrics.metric_changes(history, ["total_orders", "total_revenue"], "order_date")


@query(
    "c6_metric_changes_from_zero",
    f"""with {EVENTS}, h as (
  select order_date, count(order_id) filter (status = 'error' and hour(order_timestamp) = 3) as errors
  from order_events group by order_date)
select order_date, errors, lag(errors) over w as previous_errors,
  errors - lag(errors) over w as errors_change,
  {rounded("(errors - lag(errors) over w) * 100.0::double / nullif(lag(errors) over w, 0)")}
    as errors_change_percent
from h window w as (order by order_date)""",
)
def c6_zero(spark, sf):
    rare = (F.col("status") == "error") & (F.hour("order_timestamp") == 3)
    history = order_events(spark, sf).groupBy("order_date").agg(
        F.count(F.when(rare, F.col("order_id"))).alias("errors")
    )
    return metrics.metric_changes(history, ["errors"], "order_date")


SMALL = "round(sum({x}) * 1e6) / 1e6"


@query(
    "a5_status_totals_small_amounts",
    f"""select event_type as status, count(event_id) as count,
  {SMALL.format(x="value / 30000")} as revenue from events group by 1""",
)
def a5_small(spark, sf):
    small = order_events(spark, sf).drop("total_amount").join(
        table(spark, sf, "events").select(
            F.col("event_id").cast("string").alias("order_id"), (F.col("value") / 30000).alias("total_amount")
        ),
        "order_id",
    )
    return metrics.status_totals(small).withColumn(
        "revenue", F.rint(F.col("revenue") * 1e6) / 1e6
    )


@query(
    "c10_customer_segments",
    f"""with {HEADERS}, a as (
  select customer_id, max(order_date) as last_order_date, count(order_id) as frequency,
         {total("total_amount")} as spend,
         cast(date_diff('day', max(order_date), date '2002-01-01') as integer) as recency_days
  from order_headers group by customer_id),
q as (select quantile_disc(recency_days, [0.25, 0.5, 0.75]) as r,
             quantile_disc(frequency, [0.25, 0.5, 0.75]) as f,
             quantile_disc(spend, [0.25, 0.5, 0.75]) as m from a)
select a.*,
  1 + (r[1] < recency_days)::integer + (r[2] < recency_days)::integer + (r[3] < recency_days)::integer as recency_band,
  1 + (f[1] < frequency)::integer + (f[2] < frequency)::integer + (f[3] < frequency)::integer as frequency_band,
  1 + (m[1] < spend)::integer + (m[2] < spend)::integer + (m[3] < spend)::integer as monetary_band
from a, q""",
)
def c10(spark, sf):
    activity = segments.customer_activity(order_headers(spark, sf))
    return segments.customer_segments(activity, F.lit("2002-01-01").cast("date"))


# -- one-pass rollup -----------------------------------------------------------------------------


@query(
    "m2_rollup_overall",
    f"with {EVENTS} select {TOTALS} from order_events",
)
def m2_overall(spark, sf):
    return rollup.overall_from_rollup(rollup.order_rollup(order_events(spark, sf)))


@query(
    "m2_rollup_products",
    f"with {EVENTS}, snapshot as (select * from order_events), p as ({PRODUCT_TOTALS}) "
    "select * from p order by total_revenue desc, product_id limit 10",
)
def m2_products(spark, sf):
    return rollup.top_products_from_rollup(rollup.order_rollup(order_events(spark, sf)))


@query(
    "m2_rollup_all_slices",
    f"""with {EVENTS}
select case when grouping(product_id) = 0 then 'product'
            when grouping(customer_id) = 0 then 'customer'
            when grouping(status) = 0 then 'status'
            when grouping(hour) = 0 then 'hour' else 'overall' end as slice,
       product_id, customer_id, status, hour,
       count(order_id) as order_count, {total("total_amount")} as revenue,
       {mean("total_amount")} as mean_amount, min(total_amount) as min_amount,
       max(total_amount) as max_amount, cast(sum(quantity) as bigint) as quantity
from (select *, cast(hour(order_timestamp) as integer) as hour from order_events)
group by grouping sets ((product_id), (customer_id), (status), (hour), ())""",
)
def m2_slices(spark, sf):
    return rollup.order_rollup(order_events(spark, sf))


# -- scalar functions ----------------------------------------------------------------------------


@query(
    "f_calendar",
    f"""with {EVENTS} select order_id, cast(dayofweek(order_date) + 1 as integer) as day_of_week,
  dayname(order_date) as day_name, cast(hour(order_timestamp) as integer) as hour,
  cast(order_date as timestamp) as midnight, strftime(order_date, '%Y-%m-%d') as iso_date,
  order_date + 7 as week_later,
  regexp_replace(strftime(order_timestamp, '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '') as iso_text
from order_events""",
)
def f_calendar(spark, sf):
    return order_events(spark, sf).select(
        "order_id",
        fn.day_of_week("order_date").alias("day_of_week"),
        fn.day_name("order_date").alias("day_name"),
        fn.hour_of("order_timestamp").alias("hour"),
        fn.midnight("order_date").alias("midnight"),
        fn.iso_date("order_date").alias("iso_date"),
        F.date_add("order_date", 7).alias("week_later"),
        fn.iso_text("order_timestamp").alias("iso_text"),
    )


@query(
    "f_rounding",
    f"""with {SNAPSHOT} select order_id,
  {rounded("price / 3.0::double")} as third_2, {rounded("price / 3.0::double", 3)} as third_3
from snapshot""",
)
def f_rounding(spark, sf):
    third = F.col("price") / F.lit(3.0)
    return order_snapshot(spark, sf).select(
        "order_id", F.round(third, 2).alias("third_2"), F.round(third, 3).alias("third_3")
    )


@query(
    "f18_money_text",
    f"with {SNAPSHOT}, s as (select status, {total('total_amount')} as revenue "
    "from snapshot group by status) "
    "select status, format('{:,.2f}', revenue) as revenue_text from s",
)
def f18(spark, sf):
    totals = metrics.status_totals(order_snapshot(spark, sf))
    return totals.select("status", fn.money_text("revenue").alias("revenue_text"))


@query(
    "f14_guarded_growth",
    f"""with {HEADERS}, c as (
  select customer_id,
    {total("case when order_date < date '1997-01-01' then total_amount end")} as before,
    {total("case when order_date >= date '1997-01-01' then total_amount end")} as after
  from order_headers group by customer_id)
select customer_id, before, after,
  case when before > 0 then (after - before) / before else 0.0::double end as growth from c""",
)
def f14(spark, sf):
    old = F.col("order_date") < F.lit("1997-01-01").cast("date")
    split = order_headers(spark, sf).groupBy("customer_id").agg(
        fn.money_sum(F.when(old, F.col("total_amount"))).alias("before"),
        fn.money_sum(F.when(~old, F.col("total_amount"))).alias("after"),
    )
    return split.withColumn("growth", fn.growth(F.col("after"), F.col("before")))


# -- checks --------------------------------------------------------------------------------------

CHECKS = """
select 'not_empty' as "check", 'error' as severity, n as observed, 1::bigint as threshold,
       n >= 1 as passed from c
union all
select 'minimum_volume', 'warn', n, 50::bigint, n >= 50 from c"""


@query("q1_q2_volume_checks", f"with {SNAPSHOT}, c as (select count(*) as n from snapshot) {CHECKS}")
def q12(spark, sf):
    return quality.volume_checks(order_snapshot(spark, sf))


@query(
    "q1_not_empty_fails",
    f"with {EVENTS}, c as (select count(*) as n from order_events "
    f"where order_date = date '{EMPTY_DAY}') {CHECKS}",
)
def q1_fails(spark, sf):
    return quality.volume_checks(filters.on_date(order_events(spark, sf), EMPTY_DAY))


@query("q3_statistics", f"with {SNAPSHOT} select {SUMMARY} from snapshot")
def q3(spark, sf):
    return metrics.order_summary(order_snapshot(spark, sf), count_all_rows=True)

