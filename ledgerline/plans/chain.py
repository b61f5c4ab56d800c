"""The daily chain: metrics, export, row counts of the serving tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame

from ledgerline.plans.daily import run_daily
from ledgerline.plans.export import export_counts, run_export
from ledgerline.sinks.tables import Sink
from ledgerline.sources.lake import Lake


class ChainResult(NamedTuple):
    tables: dict[str, DataFrame]
    status: DataFrame
    counts: DataFrame


def run_chain(
    lake: Lake,
    sink: Sink,
    read_serving: Callable[[str], DataFrame],
    date: str | dt.date | None = None,
    fallback: bool = False,
    keep_history: bool = False,
) -> ChainResult:
    """Run the daily job, export its tables and count what the serving side now holds."""
    tables = run_daily(lake, date, fallback, keep_history=keep_history)
    status = run_export(lake, sink)
    return ChainResult(tables, status, export_counts(read_serving))
