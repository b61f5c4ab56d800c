"""Raw order messages: a Kafka topic, or JSON lines in a folder. Both give a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import path_exists


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str = "orders",
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Stream one topic. ``starting_offsets`` only matters before the first checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.options(**(options or {})).load()


def _start(spark: SparkSession, path: str, checkpoint: str) -> tuple[object, list[str]]:
    """The newest modification time in the folder when the stream first began, and the files that had it.

    It is written beside the checkpoint once and read by every later start. Times are the file system's own;
    only names and times are listed, no content is read.
    """
    pinned = f"{checkpoint.rstrip('/')}_start"
    if not path_exists(spark, f"{pinned}/_SUCCESS"):
        files = spark.read.format("binaryFile").load(path).select("modificationTime", "path")
        newest = files.agg(F.max("modificationTime").alias("modificationTime"))
        files.join(newest, "modificationTime").coalesce(1).write.mode("overwrite").parquet(pinned)
    rows = spark.read.schema("modificationTime timestamp, path string").parquet(pinned).collect()
    return (rows[0][0] if rows else None), [r["path"] for r in rows]


def json_lines_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    starting: str = "earliest",
    checkpoint: str | None = None,
) -> DataFrame:
    """Stream the JSON-lines files that appear in a folder.

    With ``starting="latest"`` the files that are there when the stream first begins are skipped; which ones is
    kept beside ``checkpoint``, so that files which come while the stream is down are read by the next start.
    """
    if starting not in ("earliest", "latest"):
        raise ValueError(f"unknown start {starting!r}")
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(path)
    if starting == "earliest":
        return lines
    if checkpoint is None:
        raise ValueError("a start at the newest message is kept beside the checkpoint")
    time, names = _start(spark, path, checkpoint)
    if time is None:
        return lines
    modified, name = F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")
    # tests on the file alone: whole files are left out before they are opened
    return lines.where((modified > F.lit(time)) | ((modified == F.lit(time)) & ~name.isin(names)))


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """The JSON-lines files of a folder as a batch."""
    return spark.read.text(path)
