"""The order table in Hudi's format, by Spark's own reader and writer.

The connector is a jar that the session brings (``--packages``); without it Spark says that it cannot find the source. Keys,
ordering field and a table without partitions are settings of the writer, so Hudi itself looks up keys, merges and
keeps versions. The interface is that of ``KeyedTable``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import path_exists


def connector_is_present(spark: SparkSession) -> bool:
    loader = spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    return loader.getResource("org/apache/hudi/DefaultSource.class") is not None


class HudiTable:
    def __init__(self, spark: SparkSession, path: str, name: str, schema: T.StructType, key: str, ordering: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.key, self.ordering = key, ordering
        self.settings = {
            "hoodie.table.name": name,
            "hoodie.datasource.write.table.type": "COPY_ON_WRITE",
            "hoodie.datasource.write.recordkey.field": key,
            "hoodie.datasource.write.precombine.field": ordering,
            "hoodie.datasource.write.partitionpath.field": "",
            "hoodie.datasource.write.keygenerator.class": "org.apache.hudi.keygen.NonpartitionedKeyGenerator",
        }

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/.hoodie")

    def _write(self, rows: DataFrame, operation: str) -> None:
        rows = rows.where(F.col(self.key).isNotNull())
        writer = rows.write.format("hudi").options(**self.settings)
        writer.option("hoodie.datasource.write.operation", operation).mode("append").save(self.path)

    def upsert(self, rows: DataFrame, version: int | None = None) -> None:
        """Put in rows by key; Hudi numbers its versions itself."""
        self._write(rows.select(*self.schema.names), "upsert")

    def delete(self, rows: DataFrame, version: int | None = None) -> None:
        given = set(rows.columns)
        columns = [
            F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields
        ]
        self._write(rows.select(*columns), "delete")

    def snapshot(self, as_of: str | None = None) -> DataFrame:
        """The table now, or as of an instant of Hudi's."""
        reader = self.spark.read.format("hudi")
        if as_of is not None:
            reader = reader.option("as.of.instant", as_of)
        return reader.load(self.path).select(*self.schema.names)

    def on(self, date) -> DataFrame:
        """The rows of one date."""
        return self.snapshot().where(F.col("order_date") == F.lit(date).cast("date"))

    def compact(self) -> None:
        """Nothing to do: a copy-on-write table has no log files."""
