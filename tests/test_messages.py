import datetime as dt

from pyspark.sql import functions as F

from ledgerline.streaming.messages import accepted, decode, encode, rejected

MESSAGES = [
    '{"order_id":"ORD-1","quantity":2,"price":1.5,"order_timestamp":"2024-03-01T10:11:12.123456",'
    '"status":"x","extra":1}',
    "not json",
    "",
    '{"order_id":"ORD-2","quantity":"abc","price":3.0}',
    '{"order_id":"ORD-3","quantity":2.5,"price":3,"order_timestamp":"garbage"}',
    '{"quantity":1}',
    None,
]


def raw(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    return df.select(F.col("value").cast("binary").alias("value"))


def test_decode_accepts_rows_with_an_id(spark):
    rows = {r["order_id"]: r for r in accepted(decode(raw(spark))).collect()}
    assert set(rows) == {"ORD-1", "ORD-2", "ORD-3"}
    first = rows["ORD-1"]
    assert first["total_amount"] == 3.0
    assert first["order_date"] == dt.date(2024, 3, 1)
    assert first["processing_time"] is not None
    assert rows["ORD-2"]["quantity"] is None and rows["ORD-2"]["total_amount"] is None
    assert rows["ORD-3"]["quantity"] is None and rows["ORD-3"]["order_date"] is None
    assert rows["ORD-3"]["price"] == 3.0


def test_rejected_messages_keep_their_text(spark):
    texts = [r["value"] for r in rejected(decode(raw(spark))).collect()]
    assert sorted(texts, key=str) == sorted(["not json", "", '{"quantity":1}', None], key=str)


def test_each_message_is_parsed_once(spark):
    plan = accepted(decode(raw(spark)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_keeps_microseconds_and_drops_a_zero_fraction(spark):
    df = spark.sql(
        "select 'o' order_id, 'c' customer_id, 'p' product_id, 1 quantity, 2.5D price, 's' status,"
        " explode(array(timestamp'2024-01-01 00:00:07.179575', timestamp'2024-01-01 00:00:08'))"
        " as order_timestamp"
    )
    texts = [r["value"] for r in encode(df).collect()]
    assert '"order_timestamp":"2024-01-01T00:00:07.179575"' in texts[0]
    assert '"order_timestamp":"2024-01-01T00:00:08"' in texts[1]


def test_encode_then_decode_is_the_identity(spark):
    df = spark.createDataFrame(
        [("o", "c", "p", 3, 12.35, "2024-01-01T00:00:07.179575", "s")],
        "order_id string, customer_id string, product_id string, quantity int, price double, "
        "order_timestamp string, status string",
    )
    back = accepted(decode(encode(df))).select(*df.columns)
    assert back.collect() == df.collect()
