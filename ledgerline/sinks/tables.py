"""Table sinks. A sink is a function ``(df, table) -> None`` that replaces a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Sink = Callable[[DataFrame, str], None]


def parquet_sink(root: str) -> Sink:
    """Overwrite ``root/<table>``."""

    def write(df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{table}")

    return write


def jdbc_sink(
    url: str,
    properties: dict[str, str],
    truncate: bool = False,
    connections: int = 8,
    batch_size: int = 10_000,
) -> Sink:
    """Overwrite a database table over at most ``connections`` connections.

    ``truncate`` keeps the table's definition and grants where the database allows it. Credentials
    come in through ``properties``.
    """
    options = {
        "truncate": str(truncate).lower(),
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
    }

    def write(df: DataFrame, table: str) -> None:
        df.write.options(**options).jdbc(url, table, mode="overwrite", properties=properties)

    return write


def run_statements(spark: SparkSession, url: str, properties: dict[str, str], statements: list[str]) -> None:
    """Run statements over one connection of the database's driver, all or none."""
    settings = spark.sparkContext._jvm.java.util.Properties()
    for key, value in properties.items():
        settings.setProperty(key, value)
    if "driver" in properties:
        spark.sparkContext._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    connection = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
        connection.commit()
    finally:
        connection.close()


def swapping_jdbc_sink(
    url: str,
    properties: dict[str, str],
    run_id: str,
    connections: int = 8,
    batch_size: int = 10_000,
    attempts: int = 3,
    execute: Callable[[SparkSession, str, dict[str, str], list[str]], None] = run_statements,
) -> Sink:
    """Replace a database table by a copy that is whole.

    A task that is lost after its commit writes its rows twice, and readers of a table that is being overwritten see
    part of it. So rows go to a table named by the run first; the number that Spark has sent (counted while
    writing) must be the number that the database holds, else the copy is written again; then one transaction
    swaps the tables. Readers see the old rows or the new ones.
    """
    options = {"numPartitions": str(connections), "batchsize": str(batch_size)}

    def write(df: DataFrame, table: str) -> None:
        spark = df.sparkSession
        staged = f"{table}__{run_id}"
        for _ in range(attempts):
            sent = Observation()
            counted = df.observe(sent, F.count(F.lit(1)).alias("n"))
            counted.write.options(**options).jdbc(url, staged, mode="overwrite", properties=properties)
            query = f"(select count(*) as n from {staged}) held"
            held = int(spark.read.jdbc(url, query, properties=properties).first()["n"])
            if held == sent.get["n"]:
                break
        else:
            raise RuntimeError(f"{staged} holds {held} rows, {sent.get['n']} were sent")
        execute(spark, url, properties, [f"DROP TABLE IF EXISTS {table}", f"ALTER TABLE {staged} RENAME TO {table}"])

    return write


def round_trip(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write, read back, and report rows written, rows read and whether they agree."""
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    rows_written = written.get["n"]
    return spark.read.parquet(path).agg(
        F.lit(rows_written).cast("bigint").alias("rows_written"),
        F.count("*").alias("rows_read"),
        (F.count("*") == F.lit(rows_written)).alias("matches"),
    )
