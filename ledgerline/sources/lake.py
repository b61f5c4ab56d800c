"""Where the jobs keep their tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.schemas import DAILY_METRICS, ORDER_TABLE
from ledgerline.sources.dated_table import DatedTable, KeyedTable
from ledgerline.sources.hudi import HudiTable
from ledgerline.sources.tables import read_parquet


class Lake:
    """A root folder holding the order table, the metric history and the result tables."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        late_rows: str = "event",
        keep_versions: bool = False,
        order_format: str = "parquet",
        grain: str = "day",
    ):
        """``late_rows``: ``event`` lets the newest event time win, ``arrival`` the newest write.

        ``keep_versions`` keeps the rows of every write of the order table too, for a look into the past;
        ``grain`` is the span of dates in one folder of it (coarser where days hold few rows);
        ``order_format="hudi"`` leaves the order table to Hudi's connector.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        if order_format == "hudi":
            self.orders = HudiTable(spark, self.path("orders_raw"), "orders", ORDER_TABLE, "order_id", "order_timestamp")
        else:
            self.orders = KeyedTable(
                spark,
                self.path("orders_raw"),
                ORDER_TABLE,
                key="order_id",
                date="order_date",
                ordering="order_timestamp",
                late_rows=late_rows,
                volatile=["processing_time"],
                keep_versions=keep_versions,
                grain=grain,
            )
        self.daily_metrics = DatedTable(spark, self.path("daily_analytics"), DAILY_METRICS, "processing_date")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    @property
    def quarantine_path(self) -> str:
        return self.path("orders_quarantine")

    def read(self, table: str) -> DataFrame:
        """A result table, or the snapshot of the metric history."""
        if table == "daily_analytics":
            return self.daily_metrics.snapshot()
        return read_parquet(self.spark, self.path(table))

    def overwrite(self, table: str, df: DataFrame) -> None:
        """Replace a result table."""
        df.write.mode("overwrite").parquet(self.path(table))

    def keep(self, table: str, date: str, df: DataFrame) -> None:
        """Store one date's copy of a result table; a later run of that date replaces it."""
        folder = f"{self.path(table)}_history/processing_date={date}"
        df.drop("processing_date").write.mode("overwrite").parquet(folder)

    def history(self, table: str) -> DataFrame:
        """All kept dates of a result table, with the columns of the table itself."""
        folder = f"{self.path(table)}_history"
        read_parquet(self.spark, folder)  # reports a missing history
        return self.spark.read.schema(self.read(table).schema).parquet(folder)
