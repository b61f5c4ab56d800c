"""Verification job: is there enough data, and what does it look like."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import money_sum
from ledgerline.operators.filters import preview
from ledgerline.operators.quality import MINIMUM_ROWS, checks_on_count, enforce
from ledgerline.schemas import PREVIEW_COLUMNS
from ledgerline.sources.lake import Lake


class Verification(NamedTuple):
    checks: DataFrame
    statistics: DataFrame
    by_status: DataFrame
    sample: DataFrame


def status_totals(orders: DataFrame) -> DataFrame:
    """What :func:`verification` needs to know of the orders, per status."""
    return orders.groupBy("status").agg(
        F.count("*").alias("count"),
        money_sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("priced"),
    )


def verification(
    orders: DataFrame, minimum_rows: int = MINIMUM_ROWS, totals: DataFrame | None = None
) -> Verification:
    """The checks, the statistics, rows per status (most first) and ten sample rows.

    All but the sample come from totals per status; a stored copy of those saves reading the orders again.
    """
    if totals is None:
        totals = status_totals(orders)
    rows = F.coalesce(F.sum("count"), F.lit(0).cast("bigint"))
    revenue = money_sum("revenue")
    return Verification(
        checks_on_count(totals.agg(rows.alias("observed")), minimum_rows),
        totals.agg(
            rows.alias("total_orders"),
            revenue.alias("total_revenue"),
            F.try_divide(revenue, F.sum("priced")).alias("avg_order_value"),
        ),
        totals.select("status", "count").orderBy(F.col("count").desc(), "status"),
        preview(orders, 10, PREVIEW_COLUMNS),
    )


def run_verify(lake: Lake, minimum_rows: int = MINIMUM_ROWS) -> Verification:
    """Check the order table; raises when it is missing or empty."""
    orders = lake.orders.snapshot()
    lake.overwrite("verified_status_totals", status_totals(orders))
    found = verification(orders, minimum_rows, lake.read("verified_status_totals"))
    enforce(found.checks)
    return found
