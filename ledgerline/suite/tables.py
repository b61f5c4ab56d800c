"""Queries that go through stored tables: the order table, streams, sinks and whole jobs."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ledgerline.operators import metrics, quality
from ledgerline.plans.chain import run_chain
from ledgerline.plans.daily import run_daily
from ledgerline.plans.forecast import run_forecast
from ledgerline.plans.ingest import ingest
from ledgerline.plans.smoke import run_smoke
from ledgerline.plans.verify import verification
from ledgerline.schemas import DAILY_SERVING, FORECAST_SERVING
from ledgerline.session import scratch_path
from ledgerline.sinks.export import export_tables
from ledgerline.sinks.tables import parquet_sink, round_trip
from ledgerline.sources.lake import Lake
from ledgerline.sources.messages import json_lines, json_lines_stream
from ledgerline.sources.tables import read_parquet
from ledgerline.streaming.changes import read_changes, start_change_feed
from ledgerline.streaming.ingest import run_to_end
from ledgerline.streaming.messages import accepted, decode, publish_json_lines
from ledgerline.streaming.monitor import StreamMonitor
from ledgerline.suite.adapters import (
    as_order_rows,
    order_events,
    order_log,
    order_messages,
    order_snapshot,
    table,
)
from ledgerline.suite.metrics import CHECKS, DAY, EMPTY_DAY, PRODUCT_TOTALS, TOTALS
from ledgerline.suite.metrics import SUMMARY as SUMMARY_OF_ORDERS
from ledgerline.suite.registry import EVENTS, ORDER_LOG, SNAPSHOT, query, total
from ledgerline.suite.series import EVENT_DAILY, FORECAST, SUMMARY, forecast_ctes

ISO = "strftime(order_timestamp, '%Y-%m-%dT%H:%M:%S')"
STORED = (
    f"order_id, customer_id, product_id, quantity, price, {ISO} as order_timestamp, status, "
    "total_amount, order_date"
)
# the order of the order table: newest time first, then every value, descending
NEWEST = (
    "order_timestamp desc, customer_id desc, product_id desc, quantity desc, price desc, status desc"
)


def newest(source: str) -> str:
    return (
        f"select * exclude (rk) from (select *, row_number() over (partition by order_id "
        f"order by {NEWEST}) as rk from {source}) where rk = 1"
    )


def _lake(spark, **options) -> Lake:
    # the test tables spread few rows over seven years
    return Lake(spark, scratch_path(spark, "lake"), grain="month", **options)


def _visible(orders):
    return orders.drop("processing_time")


def _filled(spark, sf, flags, **options):
    """A lake whose order table got the lines of each return flag in one write; versions count from 1."""
    lake = _lake(spark, **options)
    lines = order_log(spark, sf, "l_returnflag")
    for version, flag in enumerate(flags, 1):
        lake.orders.upsert(as_order_rows(lines.filter(F.col("l_returnflag") == flag)), version)
    return lake


def _publish(spark, sf, topic, flag):
    """Append the lines of a return flag to a folder of messages, a file from each task."""
    lines = order_log(spark, sf, "l_returnflag").filter(F.col("l_returnflag") == flag)
    publish_json_lines(lines, topic, "gzip")


# -- messages and streaming ----------------------------------------------------------------------


@query("p1_p5_decode_messages", f"with {ORDER_LOG} select {STORED} from order_log")
def decode_messages(spark, sf):
    return _visible(accepted(decode(order_messages(spark, sf))))


@query(
    "p13_k9_publish_messages",
    f"with {ORDER_LOG} select order_id, count(*) as messages from order_log group by order_id",
)
def publish(spark, sf):
    folder = scratch_path(spark, "topic")
    publish_json_lines(order_log(spark, sf), folder)
    key = F.get_json_object("value", "$.order_id").alias("order_id")
    return json_lines(spark, folder).groupBy(key).agg(F.count("*").alias("messages"))


@query(
    "m1_x1_x4_k1_stream_upsert",
    f"with {ORDER_LOG}, newest as ({newest('order_log')}) select {STORED} from newest",
)
def stream_upsert(spark, sf):
    lake = _lake(spark)
    topic = scratch_path(spark, "topic")
    # at least four files, and four batches of them
    lines = table(spark, sf, "lineitem").count()
    publish_json_lines(order_log(spark, sf), topic, "gzip", lines // 4 + 1)
    files = len(json_lines(spark, topic).inputFiles())
    raw = json_lines_stream(spark, topic, max_files_per_trigger=-(-files // 4))
    run_to_end(ingest(lake, raw, scratch_path(spark, "checkpoint"), None))
    return _visible(lake.orders.snapshot())


BAD = ["no json", '{"price": 3}', ""]


def _monitored(spark, sf):
    """Counts that a stream pushes: a batch for each return flag, and one of lines without an order id."""
    lake, topic, checkpoint = _lake(spark), scratch_path(spark, "topic"), scratch_path(spark, "checkpoint")
    with StreamMonitor(spark) as monitor:
        for flag in "RNA-":  # the stream goes on where it ended: all files of a flag are one batch
            if flag == "-":
                bad = spark.createDataFrame([(line,) for line in BAD], "value string").coalesce(1)
                bad.write.mode("append").text(topic)
            else:
                _publish(spark, sf, topic, flag)
            query = ingest(lake, json_lines_stream(spark, topic), checkpoint, None)
            run_to_end(query)
            monitor.wait_until_ended(query)
    return monitor


@query(
    "x6_stream_batch_counts",
    f"""with {ORDER_LOG}, n as (select l_returnflag as f, count(*) as n from order_log group by 1)
select case f when 'R' then 0 when 'N' then 1 else 2 end::bigint as batch_id, n as messages, n as accepted,
  0::bigint as rejected from n
union all select 3, {len(BAD)}, 0, {len(BAD)}""",
)
def x6(spark, sf):
    """What each batch read, took and set aside, as the stream reports it."""
    return _monitored(spark, sf).batches().select("batch_id", "messages", "accepted", "rejected")


@query(
    "q1_q2_stream_volume_checks",
    f"with {ORDER_LOG}, c as (select count(*) as n from order_log) {CHECKS}",
)
def q1_stream(spark, sf):
    return _monitored(spark, sf).checks()


@query(
    "s2_start_at_newest",
    f"with {ORDER_LOG}, a as (select * from order_log where l_returnflag <> 'R'), "
    f"newest as ({newest('a')}) select {STORED} from newest",
)
def s2(spark, sf):
    """The first start skips the backlog (R); what comes later is read, also what came while the stream was down (A)."""
    lake, checkpoint = _lake(spark), scratch_path(spark, "checkpoint")
    topic = scratch_path(spark, "topic")
    _publish(spark, sf, topic, "R")
    for flag in "NA":
        raw = json_lines_stream(spark, topic, starting="latest", checkpoint=checkpoint)
        run_to_end(ingest(lake, raw, checkpoint, None))
        _publish(spark, sf, topic, flag)
    raw = json_lines_stream(spark, topic, starting="latest", checkpoint=checkpoint)
    run_to_end(ingest(lake, raw, checkpoint, None))
    return _visible(lake.orders.snapshot())


@query(
    "x4_change_feed",
    f"""with {ORDER_LOG}, n as (select *, case l_returnflag when 'R' then 0 when 'N' then 1 else 2 end::bigint as batch from order_log),
ranked as (select *, dense_rank() over (partition by order_id order by order_timestamp, customer_id, product_id,
    quantity, price, status) as place,
  row_number() over (partition by order_id, batch order by {NEWEST}) as rk from n),
best as (select *, max(place) over (partition by order_id order by batch
    rows between unbounded preceding and 1 preceding) as so_far from ranked where rk = 1)
select {STORED}, batch from best where so_far is null or place > so_far""",
)
def x4(spark, sf):
    """Keys whose newest row a batch has changed, over three batches and a restart after each."""
    feed, checkpoint = scratch_path(spark, "changes"), scratch_path(spark, "checkpoint")
    topic = scratch_path(spark, "topic")
    for flag in "RNA":
        _publish(spark, sf, topic, flag)
        run_to_end(start_change_feed(json_lines_stream(spark, topic), feed, checkpoint, None))
    return read_changes(spark, feed)


# -- order table ---------------------------------------------------------------------------------


@query(
    "s3_order_snapshot",
    f"with {ORDER_LOG}, newest as ({newest('order_log')}) select {STORED} from newest",
)
def s3(spark, sf):
    return _visible(_filled(spark, sf, "RNA").orders.snapshot())


@query(
    "s3_order_snapshot_many_commits",
    f"with {ORDER_LOG}, newest as ({newest('order_log')}) select {STORED} from newest",
)
def s3_many(spark, sf):
    """All lines in five writes of arbitrary rows, so that every write touches nearly every date."""
    lake = _lake(spark)
    rows = as_order_rows(order_log(spark, sf)).persist(StorageLevel.DISK_ONLY)  # joined once for all writes
    for part in range(5):
        lake.orders.upsert(rows.filter(F.pmod(F.xxhash64("order_id", "product_id"), F.lit(5)) == part))
    rows.unpersist()
    return _visible(lake.orders.snapshot())


@query(
    "s3_order_snapshot_compacted",
    f"with {ORDER_LOG}, newest as ({newest('order_log')}) select {STORED} from newest",
)
def s3_compacted(spark, sf):
    lake = _filled(spark, sf, "RN")
    lake.orders.compact()
    late = order_log(spark, sf, "l_returnflag").filter("l_returnflag = 'A'")
    lake.orders.upsert(as_order_rows(late))
    return _visible(lake.orders.snapshot())


@query(
    "c1_time_travel",
    f"with {ORDER_LOG}, a as (select * from order_log where l_returnflag in ('R', 'N')), "
    f"newest as ({newest('a')}) select {STORED} from newest",
)
def c1(spark, sf):
    return _visible(_filled(spark, sf, "RNA", keep_versions=True).orders.snapshot(as_of=2))


@query(
    "c2_row_delete",
    f"with {ORDER_LOG}, newest as ({newest('order_log')}) "
    f"select {STORED} from newest where quantity <= 40",
)
def c2(spark, sf):
    lake = _filled(spark, sf, "RNA")
    gone = lake.orders.snapshot().filter("quantity > 40")
    lake.orders.delete(gone.select("order_id", F.lit("2100-01-01T00:00:00").alias("order_timestamp")))
    return _visible(lake.orders.snapshot())


@query(
    "c3_row_update",
    f"with {ORDER_LOG}, newest as ({newest('order_log')}) select order_id, customer_id, "
    "case when status = 'P' then 'F' else status end as status, "
    f"case when status = 'P' then '2100-01-01T00:00:00' else {ISO} end as order_timestamp, "
    "total_amount from newest",
)
def c3(spark, sf):
    lake = _filled(spark, sf, "RNA")
    pending = lake.orders.snapshot().filter("status = 'P'")
    lake.orders.upsert(
        pending.withColumn("status", F.lit("F")).withColumn(
            "order_timestamp", F.lit("2100-01-01T00:00:00")
        )
    )
    return lake.orders.snapshot().select(
        "order_id", "customer_id", "status", "order_timestamp", "total_amount"
    )


@query(
    "k2_s4_metric_upsert",
    f"""with {EVENTS}
select {TOTALS}, strftime(order_date, '%Y-%m-%d') as processing_date, false as used_fallback
from order_events where order_date >= date '{DAY}' group by order_date
union all
select {TOTALS}, strftime(order_date, '%Y-%m-%d'), false
from order_events where order_date < date '{DAY}' and status <> 'purchase' group by order_date""",
)
def k2(spark, sf):
    lake = _lake(spark)
    events = order_events(spark, sf)

    def by_date(orders):
        totals = metrics.order_totals(orders, ["order_date"])
        return totals.withColumn("processing_date", F.date_format("order_date", "yyyy-MM-dd"))

    for rows in (events.filter("status <> 'purchase'"), events.filter(F.col("order_date") >= DAY)):
        lake.daily_metrics.upsert(by_date(rows).withColumn("used_fallback", F.lit(False)))
    return lake.daily_metrics.snapshot()


# -- sinks ---------------------------------------------------------------------------------------


@query("k3_s5_parquet_overwrite", f"with {SNAPSHOT} {PRODUCT_TOTALS}")
def k3(spark, sf):
    lake = _lake(spark)
    products = metrics.product_totals(order_snapshot(spark, sf))
    lake.overwrite("products", metrics.top(products, "total_revenue", "product_id"))
    lake.overwrite("products", products)
    return lake.read("products")


@query(
    "k7_q6_round_trip",
    f"with {SNAPSHOT} select count(*) as rows_written, count(*) as rows_read, true as matches "
    "from snapshot",
)
def k7(spark, sf):
    return round_trip(spark, order_snapshot(spark, sf), scratch_path(spark, "round-trip"))


def _results(spark, sf):
    orders = order_snapshot(spark, sf)
    return {
        "daily_top_products": lambda: metrics.product_totals(orders),
        "daily_top_customers": lambda: read_parquet(spark, scratch_path(spark, "missing")),
        "daily_status_distribution": lambda: metrics.status_distribution(orders),
    }


@query(
    "k5_best_effort_export",
    f"""with {SNAPSHOT}
select 'daily_top_products' as table_name, count(distinct product_id) as row_count, true as ok
from snapshot
union all select 'daily_top_customers', null, false
union all select 'daily_status_distribution', count(distinct status), true from snapshot""",
)
def k5(spark, sf):
    sink = parquet_sink(scratch_path(spark, "serving"))
    return export_tables(spark, _results(spark, sf), sink).drop("error")


@query(
    "k6_all_in_one_try_export",
    f"""with {SNAPSHOT}
select 'daily_top_products' as table_name, count(distinct product_id) as row_count, true as ok
from snapshot
union all select 'daily_top_customers', null, false
union all select 'daily_status_distribution', null, false""",
)
def k6(spark, sf):
    sink = parquet_sink(scratch_path(spark, "serving"))
    return export_tables(spark, _results(spark, sf), sink, isolate=False).drop("error")


# -- jobs ----------------------------------------------------------------------------------------


def _event_lake(spark, sf):
    lake = _lake(spark)
    lake.orders.upsert(as_order_rows(order_events(spark, sf)))
    return lake


TOP = "order by 3 desc, 2 limit 10"
M2 = f"""with {EVENTS}, d as (
  select *, hour(order_timestamp) as hour from order_events where order_date = date '{DAY}')
select 'daily_analytics' as table_name, 'overall' as key, {total("total_amount")} as revenue,
       count(order_id) as orders, '{DAY}' as processing_date from d
union all select * from (select 'top_products_daily', product_id, {total("total_amount")} as r,
  count(order_id), '{DAY}' from d group by product_id {TOP})
union all select * from (select 'top_customers_daily', customer_id, {total("total_amount")} as r,
  count(order_id), '{DAY}' from d group by customer_id {TOP})
union all select 'status_distribution_daily', status, {total("total_amount")},
  count(order_id), '{DAY}' from d group by status
union all select 'hourly_trends_daily', cast(hour as varchar), {total("total_amount")},
  count(order_id), '{DAY}' from d group by hour"""


def _union_of_tables(tables):
    columns = {
        "daily_analytics": (F.lit("overall"), "total_revenue", "total_orders"),
        "top_products_daily": (F.col("product_id"), "total_revenue", "order_count"),
        "top_customers_daily": (F.col("customer_id"), "total_spent", "order_count"),
        "status_distribution_daily": (F.col("status"), "revenue", "count"),
        "hourly_trends_daily": (F.col("hour").cast("string"), "revenue", "order_count"),
    }
    parts = [
        tables[name].select(
            F.lit(name).alias("table_name"),
            key.alias("key"),
            F.col(revenue).alias("revenue"),
            F.col(orders).alias("orders"),
            "processing_date",
            "used_fallback",
        )
        for name, (key, revenue, orders) in columns.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


@query("m2_daily_job", M2)
def m2(spark, sf):
    return _union_of_tables(run_daily(_event_lake(spark, sf), DAY)).drop("used_fallback")


@query(
    "m2_daily_job_falls_back",
    "select *, true as used_fallback from ("
    + M2.replace(f"where order_date = date '{DAY}'", "").replace(f"'{DAY}'", f"'{EMPTY_DAY}'")
    + ")",
)
def m2_falls_back(spark, sf):
    return _union_of_tables(run_daily(_event_lake(spark, sf), EMPTY_DAY, fallback=True))


CHAIN_COUNTS = f"""with {EVENTS}, d as (
  select *, hour(order_timestamp) as hour from order_events where order_date = date '{DAY}')
select 'daily_top_products' as table_name, least(count(distinct product_id), 10) as row_count from d
union all select 'daily_top_customers', least(count(distinct customer_id), 10) from d
union all select 'daily_status_distribution', count(distinct status) from d
union all select 'daily_hourly_trends', count(distinct hour) from d
union all select 'daily_overall_metrics', 1"""


@query("m3_m6_u1_q5_daily_chain", CHAIN_COUNTS)
def m6(spark, sf):
    serving = scratch_path(spark, "serving")
    result = run_chain(
        _event_lake(spark, sf),
        parquet_sink(serving),
        lambda table: read_parquet(spark, f"{serving}/{table}"),
        DAY,
    )
    return result.counts


def _forecast_lake(spark, sf):
    lake = _event_lake(spark, sf)
    run_forecast(lake, created_at=dt.datetime(2024, 2, 1))
    return lake


@query(
    "m4_forecast_job",
    f"{EVENT_DAILY}, {forecast_ctes()} {FORECAST}".replace(
        "exclude (recent_avg, ma_14, growth_rate) from",
        "exclude (recent_avg, ma_14, growth_rate), timestamp '2024-02-01' as created_at from",
    ),
)
def m4(spark, sf):
    return _forecast_lake(spark, sf).read("revenue_forecast")


@query(
    "m4_forecast_job_summary",
    f"{EVENT_DAILY}, {forecast_ctes()} select {SUMMARY}, timestamp '2024-02-01' as created_at "
    "from forecast",
)
def m4_summary(spark, sf):
    return _forecast_lake(spark, sf).read("revenue_forecast_summary")


@query(
    "m4_forecast_export",
    f"""{EVENT_DAILY}
select 'historical_daily_revenue' as table_name, count(*) as row_count, true as ok from daily
union all select 'revenue_forecast', 7, true
union all select 'forecast_summary', 1, true
union all select 'dow_seasonality_patterns', count(distinct day_of_week), true from daily""",
)
def m4_export(spark, sf):
    lake = _forecast_lake(spark, sf)
    loads = {serving: partial(lake.read, name) for name, serving in FORECAST_SERVING.items()}
    sink = parquet_sink(scratch_path(spark, "serving"))
    return export_tables(spark, loads, sink, isolate=False).drop("error")


@query(
    "m5_smoke_job_top_products",
    f"with {EVENTS} select product_id, count(order_id) as order_count, "
    f"{total('total_amount')} as revenue from order_events group by product_id "
    "order by revenue desc, product_id limit 5",
)
def smoke(spark, sf):
    return run_smoke(_event_lake(spark, sf)).top_products


@query(
    "m5_verify_checks",
    f"with {SNAPSHOT}, c as (select count(*) as n from snapshot) {CHECKS}",
)
def m5_checks(spark, sf):
    return verification(order_snapshot(spark, sf)).checks


@query(
    "m5_verify_statistics",
    f"with {SNAPSHOT} select {SUMMARY_OF_ORDERS} from snapshot",
)
def m5_statistics(spark, sf):
    return verification(order_snapshot(spark, sf)).statistics


@query(
    "m5_verify_by_status",
    f"with {SNAPSHOT} select status, count(*) as count from snapshot group by status "
    "order by count desc, status",
)
def m5_status(spark, sf):
    return verification(order_snapshot(spark, sf)).by_status


@query(
    "u1_labelled_counts",
    f"with {SNAPSHOT} "
    + " union all ".join(
        f"select '{name}' as table_name, {count} as row_count from snapshot"
        for name, count in zip(
            DAILY_SERVING.values(),
            [
                "count(distinct product_id)",
                "count(distinct customer_id)",
                "count(distinct status)",
                "count(distinct hour(order_timestamp))",
                "least(count(*), 1)",
            ],
            strict=True,
        )
    ),
)
def u1(spark, sf):
    lake = _lake(spark)
    lake.overwrite("orders", order_snapshot(spark, sf))
    orders = lake.read("orders")
    names = list(DAILY_SERVING.values())
    tables = [
        metrics.product_totals(orders),
        metrics.customer_totals(orders),
        metrics.status_distribution(orders),
        metrics.hourly_totals(orders),
        metrics.order_totals(orders),
    ]
    return quality.labelled_counts(dict(zip(names, tables, strict=True)))
