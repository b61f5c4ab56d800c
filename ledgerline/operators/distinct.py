"""Exact distinct counts that add up: bitmaps over a dictionary of integers.

Every value gets a number once and keeps it, so a set of values is a set of bits. The bits of a day are kept in buckets
of 32,768 numbers; days, weeks or any range of dates are the OR of their days' bitmaps, and counting bits gives what
``count(distinct)`` would give, without reading the orders again. Nulls have no number and do not count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ordering import numbered
from ledgerline.session import scratch_path


def extended(known: DataFrame | None, values: DataFrame, column: str) -> DataFrame:
    """(column, number): the known numbers, and the next ones for values that have none yet."""
    new = values.select(column).where(F.col(column).isNotNull()).distinct()
    first = 0
    if known is not None:
        new = new.join(known, column, "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    new = numbered(new, [F.col(column).asc()], name="dictionary", column="number")
    new = new.withColumn("number", F.col("number") + F.lit(first))
    return new if known is None else known.unionByName(new)


def bitmaps(rows: DataFrame, dictionary: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """(keys, bucket, bits): a bitmap for each bucket of numbers that a group has values in."""
    number = F.col("number") + 1  # Spark's buckets and positions count from one
    return (
        rows.select(*keys, column)
        .join(dictionary, column)
        .groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )


def count_distinct(stored: DataFrame, keys: Sequence[Column], column: str = "distinct_values") -> DataFrame:
    """Distinct values by ``keys`` from bitmaps: buckets are joined by OR, then their bits are counted."""
    names = [f"_key{i}" for i in range(len(keys))]
    merged = stored.select(*[k.alias(n) for k, n in zip(keys, names, strict=True)], "bucket", "bits")
    merged = merged.groupBy(*names, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = merged.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias(column))
    return counted


class DistinctStore:
    """Bitmaps by date of one column, and the dictionary they rest on, as Parquet folders."""

    def __init__(self, spark, path: str, column: str, date: str = "order_date"):
        self.spark, self.path, self.column, self.date = spark, path.rstrip("/"), column, date

    def add(self, orders: DataFrame, first: bool = False) -> None:
        """Add whole dates that are not stored yet; ``first`` begins anew."""
        folder = f"{self.path}/dictionary"
        known = None if first else self.spark.read.parquet(folder)
        grown = extended(known, orders, self.column)
        staged = scratch_path(self.spark, "dictionary")  # a folder that is read cannot be overwritten
        new = grown if known is None else grown.join(known, [self.column], "left_anti")
        new.write.parquet(staged)
        mode = "overwrite" if first else "append"
        self.spark.read.schema(new.schema).parquet(staged).write.mode(mode).parquet(folder)
        days = bitmaps(orders, self.spark.read.schema(new.schema).parquet(folder), self.column, [self.date])
        # by date, so that a range of dates skips files
        days.repartitionByRange(self.date, "bucket").write.mode(mode).parquet(f"{self.path}/days")

    def days(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/days")

    def between(self, low, high, column: str = "distinct_values") -> DataFrame:
        """One row: the distinct values of the dates from ``low`` to ``high``."""
        dates = self.days().where(F.col(self.date).between(F.lit(low).cast("date"), F.lit(high).cast("date")))
        return count_distinct(dates, [], column)
