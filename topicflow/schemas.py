"""Schemas of the data model and the fixed values of the
reference's sample data and topology parameters."""

from __future__ import annotations

from pyspark.sql import types as T

# --- topic log: the Spark Kafka source schema --------------------------------
HEADER = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.BinaryType()),
])

LOG = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
    T.StructField("headers", T.ArrayType(HEADER)),
])

# --- entities (POJO -> StructType) -------------------------------------------
ORDER = T.StructType([
    T.StructField("user_name", T.StringType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("transaction_date", T.LongType()),   # epoch ms, UTC
    T.StructField("quantity", T.IntegerType()),
])

USER = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
])

ITEM = T.StructType([
    T.StructField("item_name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("price", T.DoubleType()),
])

# JSON field names of the serialised entities (bean property names).
ORDER_JSON_FIELDS = {"user_name": "userName", "item_name": "itemName",
                     "transaction_date": "transactionDate", "quantity": "quantity"}
USER_JSON_FIELDS = {"name": "name", "address": "address", "gender": "gender", "age": "age"}
ITEM_JSON_FIELDS = {"item_name": "itemName", "address": "address", "type": "type",
                    "price": "price"}

# --- fixed values: topology parameters of the reference ----------------------
TOPIC_PARTITIONS = 3                 # every topic is created with 3 partitions
ADULT_MIN_AGE, ADULT_MAX_AGE = 18, 35
TOP_ITEMS_K = 10
TOP_ITEMS_WINDOW_MS = 3_600_000      # 1 hour
TOP_ITEMS_ADVANCE_MS = 5_000         # hop 5 seconds
WORDCOUNT_WINDOW_MS = 5_000          # tumbling 5 s
FLUSH_INTERVAL_MS = 1_000            # punctuate every second
DEFAULT_RETENTION = "1 day"          # window retention when none is set
DELAY_HEADER = "delaySeconds"
DELAY_TOPIC = "test"
DELAY_LOOKBACK_S = 180
BOUNDED_FETCH_BYTES = 10_000
PAUSED_PARTITIONS = (0, 1)
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
PAYLOAD_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss:SSS"
# event time of table rows without their own (epoch ms, UTC)
ITEM_EVENT_MS = 1449795610000        # 2015-12-11T01:00:10Z
USER_EVENT_MS = 1449792010000        # 2015-12-11T00:00:10Z
OTHER_EVENT_MS = 1447113610000       # 2015-11-10T00:00:10Z

# --- fixed values: the reference's sample rows (users.csv, items.csv, orders.csv)
FIXTURE_USERS_CSV = """Jack, BJ, male, 23
Lily, SH, female, 21
Mike, SZ, male, 22
Lucy, GZ, female, 20"""

FIXTURE_ITEMS_CSV = """iphone, BJ, phone, 5388.88
ipad, SH, pad, 4888.88
iwatch, SZ, watch, 2668.88
ipod, GZ, pod, 1888.88"""

FIXTURE_ORDERS_CSV = """Jack, iphone, 2016-11-11 00:00:01, 3
Jack, ipad, 2016-11-11 00:00:02, 4
Jack, iwatch, 2016-11-11 00:00:03, 5
Jack, ipod, 2016-11-11 00:00:04, 4

Lily, ipad, 2016-11-11 00:00:06, 3
Lily, iwatch, 2016-11-11 00:00:07, 4
Lily, iphone, 2016-11-11 00:00:08, 2
Lily, ipod, 2016-11-11 00:00:09, 3

Mike, ipad, 2016-11-11 00:00:11, 2
Mike, iwatch, 2016-11-11 00:00:12, 3
Mike, iphone, 2016-11-11 00:00:13, 4
Mike, ipod, 2016-11-11 00:00:14, 3

Lucy, ipod, 2016-11-11 00:00:16, 3
Lucy, ipad, 2016-11-11 00:00:17, 4
Lucy, iwatch, 2016-11-11 00:00:18, 3
Lucy, iphone, 2016-11-11 00:00:19, 5"""
