"""All daily metric tables from one pass over the orders.

One GROUPING SETS aggregate computes the totals per product, per customer, per status, per hour and
overall. It reads and shuffles the orders once where five separate aggregates would do so five times,
and the distinct counts become counts of groups. The rollup is as large as the number of distinct
products and customers; write it out once and build the tables from the written copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import hour_of, money_mean, money_sum
from ledgerline.operators.metrics import share_of_total, top

SLICES = {"product_id": "product", "customer_id": "customer", "status": "status", "hour": "hour"}


def order_rollup(orders: DataFrame, timestamp: str = "order_timestamp") -> DataFrame:
    """Totals per product, customer, status, hour and overall, told apart by ``slice``."""
    keyed = orders.select(
        "order_id",
        "product_id",
        "customer_id",
        "status",
        hour_of(timestamp).alias("hour"),
        "quantity",
        "total_amount",
    )
    slice_name = F.lit("overall")
    for column, name in SLICES.items():
        slice_name = F.when(F.grouping(column) == 0, F.lit(name)).otherwise(slice_name)
    return keyed.groupingSets([[column] for column in SLICES] + [[]], *SLICES).agg(
        slice_name.alias("slice"),
        F.count("order_id").alias("order_count"),
        money_sum("total_amount").alias("revenue"),
        money_mean("total_amount").alias("mean_amount"),
        F.min("total_amount").alias("min_amount"),
        F.max("total_amount").alias("max_amount"),
        F.sum("quantity").alias("quantity"),
    )


def _slice(rollup: DataFrame, name: str) -> DataFrame:
    return rollup.filter(F.col("slice") == name)


def overall_from_rollup(rollup: DataFrame) -> DataFrame:
    """The one-row metrics table."""

    def overall(column: str):
        return F.max(F.when(F.col("slice") == "overall", F.col(column)))

    def groups(name: str, key: str):
        return F.count(F.when(F.col("slice") == name, F.col(key)))

    return rollup.agg(
        F.coalesce(overall("order_count"), F.lit(0).cast("bigint")).alias("total_orders"),
        overall("revenue").alias("total_revenue"),
        overall("mean_amount").alias("avg_order_value"),
        overall("min_amount").alias("min_order"),
        overall("max_amount").alias("max_order"),
        groups("customer", "customer_id").alias("unique_customers"),
        groups("product", "product_id").alias("unique_products"),
    )


def top_products_from_rollup(rollup: DataFrame, k: int = 10) -> DataFrame:
    """The best products by revenue."""
    products = _slice(rollup, "product").select(
        "product_id",
        "order_count",
        F.col("revenue").alias("total_revenue"),
        F.col("mean_amount").alias("avg_revenue"),
        F.col("quantity").alias("total_quantity"),
    )
    return top(products, "total_revenue", "product_id", k)


def top_customers_from_rollup(rollup: DataFrame, k: int = 10) -> DataFrame:
    """The best customers by spend."""
    customers = _slice(rollup, "customer").select(
        "customer_id",
        "order_count",
        F.col("revenue").alias("total_spent"),
        F.col("mean_amount").alias("avg_order_value"),
    )
    return top(customers, "total_spent", "customer_id", k)


def status_from_rollup(rollup: DataFrame) -> DataFrame:
    """Orders, revenue and share of orders per status."""
    return share_of_total(
        _slice(rollup, "status").select("status", F.col("order_count").alias("count"), "revenue"),
        total=_slice(rollup, "overall").select("order_count"),
    )


def hourly_from_rollup(rollup: DataFrame) -> DataFrame:
    """Orders and revenue per hour of day, in hour order."""
    return _slice(rollup, "hour").select("hour", "order_count", "revenue").orderBy("hour")
