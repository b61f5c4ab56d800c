"""Reading result tables and serving tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class TableUnavailable(RuntimeError):
    """A table that a job needs is missing or cannot be read."""


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A result table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        raise TableUnavailable(f"cannot read {path}: {error}") from error


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A serving table; one task and connection per predicate when predicates are given."""
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    return spark.read.jdbc(url, table, properties=properties)
