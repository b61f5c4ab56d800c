"""The test tables seen as order tables, with amounts in whole cents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.latest import latest_per_key
from ledgerline.streaming.messages import encode

ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "product_id",
    "quantity",
    "price",
    "order_timestamp",
    "status",
    "total_amount",
    "order_date",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_shipdate",
        "l_returnflag",
    )


def _unit_price() -> Column:
    cents = F.rint(F.col("l_extendedprice") * 100.0).cast("bigint")
    quantity = F.col("l_quantity").cast("bigint")
    price_cents = F.call_function("div", cents * 2 + quantity, quantity * 2)
    return price_cents.cast("double")


def _cents(amount: str) -> Column:
    """An amount of two decimals as whole cents."""
    return F.rint(F.col(amount) * 100.0)


def _as_orders(lines: DataFrame, headers: DataFrame, *extra: str) -> DataFrame:
    joined = lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        joined.withColumn("quantity", F.col("l_quantity").cast("int"))
        .withColumn("price", _unit_price())
        .select(
            F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            "quantity",
            "price",
            F.col("l_shipdate").cast("timestamp").alias("order_timestamp"),
            F.col("o_orderstatus").alias("status"),
            (F.col("quantity") * F.col("price")).alias("total_amount"),
            F.col("l_shipdate").cast("date").alias("order_date"),
            *extra,
        )
    )


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def order_log(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Order rows with repeated keys."""
    return _as_orders(_lines(spark, sf_dir), _headers(spark, sf_dir), *extra)


def order_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row per order id.

    The newest line is chosen before the join: fewer rows are joined, and a key repeated many times
    is down to one row by then.
    """
    newest = [
        F.col(c).desc_nulls_last()
        for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    ]
    lines = latest_per_key(_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], newest)
    return _as_orders(lines, _headers(spark, sf_dir))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as orders with a time of day; the product is the number in the properties."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.lit(1).alias("quantity"),
        _cents("value").alias("price"),
        F.col("ts").cast("timestamp").alias("order_timestamp"),
        F.col("event_type").alias("status"),
        _cents("value").alias("total_amount"),
        F.col("ts").cast("date").alias("order_date"),
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers as orders: a long series with gaps."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        _cents("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").cast("timestamp").alias("order_timestamp"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order log as JSON messages."""
    return encode(order_log(spark, sf_dir))


def as_order_rows(orders: DataFrame) -> DataFrame:
    """Orders in the shape of the stored order table: text timestamps and an ingest time."""
    from ledgerline.functions import iso_text
    from ledgerline.schemas import ORDER_TABLE

    rows = orders.withColumn("order_timestamp", iso_text("order_timestamp")).withColumn(
        "processing_time", F.current_timestamp()
    )
    return rows.select(*(F.col(f.name).cast(f.dataType) for f in ORDER_TABLE.fields))
