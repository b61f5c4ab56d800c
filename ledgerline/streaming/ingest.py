"""Micro-batch ingest of order messages into the order table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.sources.dated_table import KeyedTable
from ledgerline.streaming.messages import accepted, decode, rejected
from ledgerline.streaming.monitor import BATCH_COUNTS


def start_ingest(
    raw: DataFrame,
    table: KeyedTable,
    quarantine_path: str,
    checkpoint: str,
    interval: str | None = "10 seconds",
    name: str = "order-ingest",
) -> StreamingQuery:
    """Start the stream: decode, upsert rows with an order id, set the others aside.

    ``interval=None`` reads what is there and stops. A replayed batch puts the same rows in by key and replaces
    its own folder of the quarantine. Messages are counted on their way (see ``monitor``); nothing is read
    again for a count.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or name
        batch.persist()  # one pass decodes and counts, the writes below read its result
        try:
            table.upsert(accepted(batch))
            (
                rejected(batch)
                .withColumn("_batch", F.lit(f"{query}.{batch_id}"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("_batch")
                .parquet(quarantine_path)
            )
        finally:
            batch.unpersist()

    counted = decode(raw).observe(
        BATCH_COUNTS,
        F.count(F.lit(1)).alias("messages"),
        F.count("order_id").alias("accepted"),
        F.count_if(F.col("order_id").isNull()).alias("rejected"),
    )
    writer = (
        counted.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def run_to_end(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Block until the stream stops, at most ``timeout`` seconds; True if it stopped."""
    return query.awaitTermination() or True if timeout is None else query.awaitTermination(timeout)
