"""Order metrics: totals, rankings, shares and trends.

Sums of money use :func:`money_sum`, counts of orders skip null ids. Every ranking breaks ties by
its group key, ascending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import RANK_PLACES, hour_of, money_mean, money_sum


def row_count(df: DataFrame) -> DataFrame:
    """One row: number of rows."""
    return df.agg(F.count("*").alias("row_count"))


def order_totals(orders: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Orders, revenue, mean, smallest and largest order, distinct customers and products.

    One row, or one per value of ``keys``.
    """
    return orders.groupBy(*keys).agg(
        F.count("order_id").alias("total_orders"),
        money_sum("total_amount").alias("total_revenue"),
        money_mean("total_amount").alias("avg_order_value"),
        F.min("total_amount").alias("min_order"),
        F.max("total_amount").alias("max_order"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("product_id").alias("unique_products"),
    )


def order_summary(orders: DataFrame, count_all_rows: bool = False) -> DataFrame:
    """One row: orders, revenue, mean. ``count_all_rows`` counts rows without an order id too."""
    return orders.agg(
        F.count(F.lit(1) if count_all_rows else F.col("order_id")).alias("total_orders"),
        money_sum("total_amount").alias("total_revenue"),
        money_mean("total_amount").alias("avg_order_value"),
    )


def product_totals(orders: DataFrame) -> DataFrame:
    """Orders, revenue, mean revenue and quantity per product."""
    return orders.groupBy("product_id").agg(
        F.count("order_id").alias("order_count"),
        money_sum("total_amount").alias("total_revenue"),
        money_mean("total_amount").alias("avg_revenue"),
        F.sum("quantity").alias("total_quantity"),
    )


def product_revenue(orders: DataFrame) -> DataFrame:
    """Orders and revenue per product."""
    return orders.groupBy("product_id").agg(
        F.count("order_id").alias("order_count"), money_sum("total_amount").alias("revenue")
    )


def customer_totals(orders: DataFrame) -> DataFrame:
    """Orders, spend and mean order per customer."""
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"),
        money_sum("total_amount").alias("total_spent"),
        money_mean("total_amount").alias("avg_order_value"),
    )


def status_totals(orders: DataFrame) -> DataFrame:
    """Orders and revenue per status."""
    return orders.groupBy("status").agg(
        F.count("order_id").alias("count"), money_sum("total_amount").alias("revenue")
    )


def hourly_totals(orders: DataFrame, timestamp: str = "order_timestamp") -> DataFrame:
    """Orders and revenue per hour of day."""
    return orders.groupBy(hour_of(timestamp).alias("hour")).agg(
        F.count("order_id").alias("order_count"), money_sum("total_amount").alias("revenue")
    )


def status_counts(orders: DataFrame) -> DataFrame:
    """Rows per status."""
    return orders.groupBy("status").agg(F.count("*").alias("count"))


def top(df: DataFrame, by: str, key: str, k: int = 10) -> DataFrame:
    """The ``k`` rows with the largest ``by`` (sums rounded to ``RANK_PLACES``); ties in key order."""
    rank = F.round(F.col(by), RANK_PLACES) if dict(df.dtypes)[by] == "double" else F.col(by)
    return df.orderBy(rank.desc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)


def percent_of(part: Column, whole: Column) -> Column:
    """Percentage with two decimals, null where the whole is 0."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole), 2)


def share_of_total(
    df: DataFrame, column: str = "count", name: str = "percentage", total: DataFrame | None = None
) -> DataFrame:
    """Add each row's percentage of the column total.

    The one-row total (``total`` when it is known already) is joined by broadcast and the rows stay
    where they are, so keys need no small bound.
    """
    if total is None:
        total = df.agg(F.sum(column))
    joined = df.crossJoin(F.broadcast(total.toDF("_total")))
    return joined.withColumn(name, percent_of(F.col(column), F.col("_total"))).drop("_total")


def status_distribution(orders: DataFrame) -> DataFrame:
    """Orders, revenue and share of orders per status."""
    return share_of_total(status_totals(orders))


def hourly_trends(orders: DataFrame, timestamp: str = "order_timestamp") -> DataFrame:
    """Hourly totals in hour order."""
    return hourly_totals(orders, timestamp).orderBy("hour")


def hourly_status_trend(
    orders: DataFrame, timestamp: str = "order_timestamp", statuses: Sequence[str] | None = None
) -> DataFrame:
    """Orders and revenue per hour and status; one count column per status when they are listed."""
    hour = hour_of(timestamp).alias("hour")
    if statuses is None:
        return orders.groupBy(hour, F.col("status")).agg(
            F.count("order_id").alias("order_count"), money_sum("total_amount").alias("revenue")
        )
    counts = [
        F.count(F.when(F.col("status") == status, F.col("order_id"))).alias(f"{status}_orders")
        for status in statuses
    ]
    return orders.groupBy(hour).agg(*counts)


def metric_changes(
    history: DataFrame, metrics: Sequence[str], date: str = "processing_date"
) -> DataFrame:
    """Each date's metrics next to the previous date's: value, change and percent change (null from 0).

    One row per date enters the window, so a single partition is bounded by the calendar.
    """
    by_date = Window.orderBy(date)
    columns = [F.col(date)]
    for metric in metrics:
        previous = F.lag(metric).over(by_date)
        columns += [
            F.col(metric),
            previous.alias(f"previous_{metric}"),
            (F.col(metric) - previous).alias(f"{metric}_change"),
            percent_of(F.col(metric) - previous, previous).alias(f"{metric}_change_percent"),
        ]
    return history.select(*columns)
