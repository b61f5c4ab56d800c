"""Export of several tables, best effort or all in one try."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sinks.tables import Sink

STATUS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("error", T.StringType()),
    ]
)


def export_tables(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    sink: Sink,
    isolate: bool = True,
) -> DataFrame:
    """Write each table and return one status row per table, in order.

    With ``isolate`` every table has its own try. Without it the first failure skips the rest, which
    are reported as skipped. Rows are counted while they are written, not by another scan.
    """
    status, failed = [], False
    for name, load in tables.items():
        if failed and not isolate:
            status.append((name, None, False, "skipped"))
            continue
        try:
            written = Observation()
            sink(load().observe(written, F.count(F.lit(1)).alias("n")), name)
            status.append((name, written.get["n"], True, None))
        except Exception as error:  # a failed table is reported, not raised
            failed = True
            status.append((name, None, False, f"{type(error).__name__}: {error}"))
    return spark.createDataFrame(status, STATUS)
