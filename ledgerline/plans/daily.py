"""Daily job: five metric tables of one day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.operators import rollup as R
from ledgerline.operators.filters import on_date_or_all, with_run_date
from ledgerline.session import drop_scratch, scratch_path
from ledgerline.sources.lake import Lake


def daily_tables(rollup: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """The metric tables built from a day's rollup, by lake table name."""
    return {
        "daily_analytics": R.overall_from_rollup(rollup),
        "top_products_daily": R.top_products_from_rollup(rollup, k),
        "top_customers_daily": R.top_customers_from_rollup(rollup, k),
        "status_distribution_daily": R.status_from_rollup(rollup),
        "hourly_trends_daily": R.hourly_from_rollup(rollup),
    }


def _stage(lake: Lake, orders: DataFrame, path: str) -> DataFrame:
    """Write the rollup of some orders and return the written copy."""
    rollup = R.order_rollup(orders)
    rollup.write.mode("overwrite").partitionBy("slice").parquet(path)
    return lake.spark.read.schema(rollup.schema).parquet(path)


def run_daily(
    lake: Lake,
    date: str | dt.date | None = None,
    fallback: bool = False,
    k: int = 10,
    keep_history: bool = False,
) -> dict[str, DataFrame]:
    """Compute and store the metrics of ``date`` (yesterday by default); returns the stored tables.

    The orders are read once, into a rollup written to the shared scratch folder; the five tables
    are built from that copy. Overall metrics are upserted by date, the other tables are replaced;
    ``keep_history`` also keeps a copy of those per date.
    With ``fallback`` a day without orders uses all orders instead; ``used_fallback`` says so in every
    table, the metric history included.
    """
    spark = lake.spark
    if date is None:
        date = spark.range(1).select(F.date_sub(F.current_date(), 1)).first()[0]
    picked = on_date_or_all(lake.orders.snapshot(), date) if fallback else lake.orders.on(date)
    scratch = scratch_path(spark, "daily-rollup")
    try:
        seen = Observation()
        if fallback:  # the pass that reads the orders also tells which ones it read
            picked = picked.observe(seen, F.bool_or("used_fallback").alias("used_fallback"))
        rollup = _stage(lake, picked, scratch)
        used_fallback = bool(fallback and seen.get["used_fallback"])
        tables = daily_tables(rollup, k)
        for name, table in tables.items():
            table = with_run_date(table, date).withColumn("used_fallback", F.lit(used_fallback))
            if name == "daily_analytics":
                lake.daily_metrics.upsert(table)
                continue
            lake.overwrite(name, table)
            if keep_history:
                lake.keep(name, str(date), lake.read(name))
    finally:
        drop_scratch(spark, scratch)
    return {name: lake.read(name) for name in tables}
