"""Smoke job: read the orders, compute a little, write it and read it back."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.metrics import order_summary, product_revenue, top
from ledgerline.sinks.tables import round_trip
from ledgerline.sources.lake import Lake


class Smoke(NamedTuple):
    summary: DataFrame
    top_products: DataFrame
    round_trip: DataFrame


def run_smoke(lake: Lake, k: int = 5) -> Smoke:
    """Summary, best products, and the outcome of storing the summary as ``test_analytics``."""
    orders = lake.orders.snapshot()
    summary = order_summary(orders)
    stamped = summary.withColumn("test_date", F.current_date())
    return Smoke(
        summary,
        top(product_revenue(orders), "revenue", "product_id", k),
        round_trip(lake.spark, stamped, lake.path("test_analytics")),
    )
