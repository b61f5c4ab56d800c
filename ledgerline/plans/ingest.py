"""Ingest job: message stream -> order table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerline.sources.lake import Lake
from ledgerline.streaming.ingest import start_ingest


def ingest(lake: Lake, raw: DataFrame, checkpoint: str, interval: str | None = "10 seconds") -> StreamingQuery:
    """Keep the order table up to date from a raw stream."""
    return start_ingest(raw, lake.orders, lake.quarantine_path, checkpoint, interval)


def compact(lake: Lake) -> None:
    """Write the dates of the order table anew, in files of an even size."""
    if lake.orders.exists():
        lake.orders.compact()
