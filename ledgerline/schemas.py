"""Schemas, column orders and table names shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: message schema, table columns and table names that readers depend on ---------

ORDER_MESSAGE = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("order_timestamp", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

ORDER_TABLE = T.StructType(
    ORDER_MESSAGE.fields
    + [
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("processing_time", T.TimestampType()),
        T.StructField("order_date", T.DateType()),
    ]
)

DAILY_METRICS = T.StructType(
    [
        T.StructField("total_orders", T.LongType()),
        T.StructField("total_revenue", T.DoubleType()),
        T.StructField("avg_order_value", T.DoubleType()),
        T.StructField("min_order", T.DoubleType()),
        T.StructField("max_order", T.DoubleType()),
        T.StructField("unique_customers", T.LongType()),
        T.StructField("unique_products", T.LongType()),
        T.StructField("processing_date", T.StringType()),
        T.StructField("used_fallback", T.BooleanType()),
    ]
)

DAILY_METRICS_EXPORT = [
    "processing_date",
    "total_orders",
    "total_revenue",
    "avg_order_value",
    "min_order",
    "max_order",
    "unique_customers",
    "unique_products",
]

PREVIEW_COLUMNS = [
    "order_id",
    "customer_id",
    "product_id",
    "total_amount",
    "status",
    "order_date",
]

FORECAST_COLUMNS = [
    "forecast_date",
    "day_of_week",
    "day_name",
    "forecast_revenue",
    "forecast_ma",
    "forecast_wma",
    "forecast_es",
    "lower_bound",
    "upper_bound",
    "seasonality_factor",
    "confidence_level",
]

SUMMARY_COLUMNS = [
    "forecast_period_start",
    "forecast_period_end",
    "total_forecasted_revenue",
    "avg_daily_forecast",
    "historical_avg_7d",
    "historical_avg_14d",
    "growth_rate_percent",
    "forecast_method",
    "confidence_level",
]

# lake directory -> serving table, for the daily job
DAILY_SERVING = {
    "top_products_daily": "daily_top_products",
    "top_customers_daily": "daily_top_customers",
    "status_distribution_daily": "daily_status_distribution",
    "hourly_trends_daily": "daily_hourly_trends",
    "daily_analytics": "daily_overall_metrics",
}

# lake directory -> serving table, for the forecast job
FORECAST_SERVING = {
    "historical_daily_revenue": "historical_daily_revenue",
    "revenue_forecast": "revenue_forecast",
    "revenue_forecast_summary": "forecast_summary",
    "dow_seasonality_patterns": "dow_seasonality_patterns",
}

FORECAST_METHOD = "Ensemble (MA + WMA + ES)"

# --- end of fixed values ------------------------------------------------------------------------
