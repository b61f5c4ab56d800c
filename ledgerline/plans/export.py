"""Export job: metric tables of the lake -> serving tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from ledgerline.operators.quality import labelled_counts
from ledgerline.schemas import DAILY_METRICS_EXPORT, DAILY_SERVING
from ledgerline.sinks.export import export_tables
from ledgerline.sinks.tables import Sink
from ledgerline.sources.lake import Lake


def _load(lake: Lake, table: str) -> DataFrame:
    df = lake.read(table)
    return df.select(*DAILY_METRICS_EXPORT) if table == "daily_analytics" else df


def run_export(lake: Lake, sink: Sink) -> DataFrame:
    """Write the five daily tables through ``sink``; a failed table does not stop the others."""
    loads = {serving: partial(_load, lake, table) for table, serving in DAILY_SERVING.items()}
    return export_tables(lake.spark, loads, sink)


def export_counts(read) -> DataFrame:
    """Row counts of the serving tables; ``read`` maps a table name to a DataFrame."""
    return labelled_counts({name: read(name) for name in DAILY_SERVING.values()})
