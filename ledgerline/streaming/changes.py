"""The newest row of every order as a feed of changes.

A stateful aggregate keeps, for each key, the largest row by time and values. After a batch it gives out only keys
whose newest row came with that batch: a late older row, or one that was there already, changes nothing. The
state lives in Spark's RocksDB store, on the executors' disks with copies in the checkpoint folder, so its size is
not bound by memory and a restart goes on where it ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.schemas import ORDER_TABLE
from ledgerline.streaming.messages import accepted, decode

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VALUES = [f.name for f in ORDER_TABLE.fields if f.name not in ("order_id", "processing_time")]


def changed_orders(raw: DataFrame) -> DataFrame:
    """Streaming rows (order_id, values of the newest row) of the keys that a batch has changed; for update mode."""
    rows = accepted(decode(raw))
    came = F.unix_micros("processing_time")
    # of equal rows the one that came first stays, so that a repeated message is no change
    version = F.struct(F.col("order_timestamp").try_cast("timestamp").alias("_at"), *VALUES, (-came).alias("_came"))
    newest = rows.groupBy("order_id").agg(F.max(version).alias("newest"))
    now = F.unix_micros(F.current_timestamp())  # one value for a batch, in decode as here
    return newest.where(F.col("newest._came") == -now).select("order_id", *[f"newest.{c}" for c in VALUES])


def start_change_feed(
    raw: DataFrame, path: str, checkpoint: str, interval: str | None = "10 seconds", name: str = "order-changes"
) -> StreamingQuery:
    """Write the changes of each batch to its own folder of ``path``; a replayed batch replaces its folder."""
    spark = raw.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(path)
        )

    writer = (
        changed_orders(raw)
        .writeStream.queryName(name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # a stream takes the settings of the session when it starts
    try:
        return writer.trigger(**trigger).start()
    finally:
        spark.conf.set(PROVIDER, before)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The feed written so far, with the batch of each change."""
    kinds = {f.name: f.dataType.simpleString() for f in ORDER_TABLE.fields}
    columns = ", ".join(f"{c} {kinds[c]}" for c in ("order_id", *VALUES))
    return spark.read.schema(f"{columns}, batch long").parquet(path)
