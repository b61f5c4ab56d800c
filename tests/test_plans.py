"""What the physical plans must look like for the queries to scale."""

import pytest

from pyspark.sql import functions as F

from ledgerline.operators import filters, forecast, metrics, rollup, segments, timeseries
from ledgerline.suite.adapters import order_events, order_headers, order_snapshot
from ledgerline.suite.registry import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    text = plan(df)
    return text[: text.index("== Initial Plan")]


def test_date_filter_is_pushed_to_the_scan(spark, sf_dir):
    text = plan(filters.on_date(order_events(spark, sf_dir), "2024-01-15"))
    assert "GreaterThanOrEqual(ts,2024-01-15" in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(metrics.hourly_totals(order_events(spark, sf_dir)))
    schema = text[text.index("ReadSchema: ") :].split(">")[0]
    assert "props" not in schema and "user_id" not in schema and "value" in schema


def test_fallback_branch_is_not_read_when_the_day_has_rows(spark, sf_dir):
    df = filters.on_date_or_all(order_events(spark, sf_dir), "2024-01-15")
    assert final_plan(df).count("FileScan") == 1


def test_forecast_reads_its_source_once(spark, sf_dir):
    days = timeseries.daily_revenue(order_events(spark, sf_dir))
    for df in (
        forecast.revenue_forecast(days),
        forecast.forecast_summary(forecast.forecast_details(days)),
        timeseries.weekday_seasonality(days),
    ):
        assert plan(df).count("FileScan") == 1


def test_series_forecast_shuffles_only_aggregates(spark, sf_dir):
    text = plan(
        forecast.revenue_forecast(
            timeseries.daily_revenue(order_events(spark, sf_dir), ["status"]), ["status"]
        )
    )
    assert "SinglePartition" not in text


def test_rollup_reads_and_shuffles_once(spark, sf_dir):
    text = plan(rollup.order_rollup(order_events(spark, sf_dir)))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_segments_read_their_source_once(spark, sf_dir):
    activity = segments.customer_activity(order_headers(spark, sf_dir))
    text = final_plan(segments.customer_segments(activity, F.lit("2002-01-01").cast("date")))
    assert text.count("FileScan") == 1


def test_top_k_is_not_a_global_sort(spark, sf_dir):
    totals = metrics.product_totals(order_snapshot(spark, sf_dir))
    text = plan(metrics.top(totals, "total_revenue", "product_id"))
    assert "TakeOrderedAndProject" in text


def test_wide_share_keeps_rows_in_place(spark, sf_dir):
    totals = metrics.customer_totals(order_headers(spark, sf_dir))
    text = plan(metrics.share_of_total(totals, "order_count"))
    assert "Window" not in text


def test_status_shares_pass_no_single_task(spark, sf_dir):
    text = plan(metrics.status_distribution(order_events(spark, sf_dir)))
    assert "Window" not in text
    rolled = rollup.order_rollup(order_events(spark, sf_dir))
    assert "Window" not in plan(rollup.status_from_rollup(rolled))


@pytest.mark.parametrize(
    "name", [n for n in QUERIES if n[0] in "agwtpcfq" and not n.startswith(("c1_", "c2_", "c3_"))]
)
def test_no_python_and_no_cartesian_product(spark, sf_dir, name):
    text = plan(QUERIES[name].run(spark, sf_dir))
    assert "Python" not in text and "CartesianProduct" not in text
