"""Forecast job: daily history, weekday seasonality, seven-day forecast and its summary."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.forecast import forecast_details, forecast_rows, forecast_summary
from ledgerline.operators.timeseries import daily_revenue, weekday_seasonality
from ledgerline.schemas import FORECAST_SERVING
from ledgerline.sinks.export import export_tables
from ledgerline.sinks.tables import Sink
from ledgerline.sources.lake import Lake


def run_forecast(
    lake: Lake,
    sink: Sink | None = None,
    created_at: dt.datetime | None = None,
    **options,
) -> DataFrame | None:
    """Compute and store the four forecast tables; export them when a sink is given.

    The order table is aggregated once, into the stored daily history; everything else is computed
    from that small stored table. All rows of a run carry the same ``created_at``. The export stops
    at its first failure, the lake tables are kept either way. Returns the export status.
    """
    stamp = F.lit(created_at or dt.datetime.now()).cast("timestamp")
    lake.overwrite(
        "historical_daily_revenue", daily_revenue(lake.orders.snapshot(), created_at=stamp)
    )
    daily = lake.read("historical_daily_revenue").drop("created_at")
    details = forecast_details(daily, **options)
    lake.overwrite("revenue_forecast", forecast_rows(details, created_at=stamp))
    lake.overwrite("revenue_forecast_summary", forecast_summary(details, created_at=stamp))
    lake.overwrite("dow_seasonality_patterns", weekday_seasonality(daily, created_at=stamp))
    if sink is None:
        return None
    loads = {serving: partial(lake.read, table) for table, serving in FORECAST_SERVING.items()}
    return export_tables(lake.spark, loads, sink, isolate=False)
