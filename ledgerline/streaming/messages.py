"""Decoding and encoding of order messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import iso_text, order_date
from ledgerline.schemas import ORDER_MESSAGE


def decode(raw: DataFrame) -> DataFrame:
    """Order rows of raw messages, with the message text kept in ``_message``.

    Unknown fields are ignored, a field of the wrong type is null, and a message that is not JSON
    gives a row of nulls.
    """
    text = raw.select(F.col("value").cast("string").alias("_message"))
    # inline() parses each message once; a plain select would parse again for a later filter
    parsed = text.select(F.inline(F.array(F.from_json("_message", ORDER_MESSAGE))), "_message")
    return (
        parsed
        .withColumn("total_amount", F.col("quantity") * F.col("price"))
        .withColumn("processing_time", F.current_timestamp())
        .withColumn("order_date", order_date("order_timestamp"))
    )


def accepted(decoded: DataFrame) -> DataFrame:
    """Rows with an order id."""
    return decoded.filter(F.col("order_id").isNotNull()).drop("_message")


def rejected(decoded: DataFrame) -> DataFrame:
    """Raw text of the messages without an order id, with the time they were read."""
    return decoded.filter(F.col("order_id").isNull()).select(
        F.col("_message").alias("value"), "processing_time"
    )


def encode(orders: DataFrame) -> DataFrame:
    """One JSON message per order in ``value``; timestamps become ISO text with microseconds."""
    fields = [
        iso_text(field.name).alias(field.name)
        if field.name == "order_timestamp" and orders.schema[field.name].dataType != field.dataType
        else F.col(field.name).cast(field.dataType).alias(field.name)
        for field in ORDER_MESSAGE.fields
    ]
    return orders.select(F.to_json(F.struct(*fields)).alias("value"))


def publish_json_lines(orders: DataFrame, path: str, compression: str = "none", most_rows: int = 0) -> None:
    """Append the encoded orders to a folder of JSON lines, a file for each task and ``most_rows`` (0: any number)."""
    encode(orders).write.mode("append").option("maxRecordsPerFile", most_rows).text(path, compression=compression)


def publish_kafka(orders: DataFrame, servers: str, topic: str = "orders") -> None:
    """Append the encoded orders to a topic."""
    (
        encode(orders)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
