"""Run-date filters and previews."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_date(date: str | dt.date | None = None) -> Column:
    """The processing date as a DATE column: the given day, or yesterday."""
    if date is None:
        return F.date_sub(F.current_date(), 1)
    return F.lit(dt.date.fromisoformat(str(date)))


def on_date(df: DataFrame, date: str | dt.date | None, column: str = "order_date") -> DataFrame:
    """Rows of one day; a typed literal, so the comparison reaches the parquet scan."""
    return df.filter(F.col(column) == run_date(date))


def on_date_or_all(
    df: DataFrame, date: str | dt.date | None, column: str = "order_date"
) -> DataFrame:
    """Rows of one day or, if that day has none, every row; ``used_fallback`` tells which.

    The choice is made inside the plan: the whole table is joined with a one-row marker that exists
    only when the day is empty. Once AQE sees the empty broadcast it drops that branch unread.
    """
    day = on_date(df, date, column)
    day_is_empty = (
        day.select(F.lit(1).alias("one"))
        .limit(1)
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") == 0)
        .select(F.lit(True).alias("used_fallback"))
    )
    everything = df.crossJoin(F.broadcast(day_is_empty))
    return day.withColumn("used_fallback", F.lit(False)).unionByName(everything)


def with_run_date(
    df: DataFrame, date: str | dt.date | None, column: str = "processing_date"
) -> DataFrame:
    """Tag every row with the run date as ``yyyy-MM-dd`` text."""
    return df.withColumn(column, F.date_format(run_date(date), "yyyy-MM-dd"))


def preview(
    df: DataFrame, n: int = 10, columns: Sequence[str] | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """The first ``n`` rows, optionally of some columns and in a stated order."""
    if order_by:
        df = df.orderBy(*order_by)
    return (df.select(*columns) if columns else df).limit(n)
