"""Map the driver's TPC-H-ish tables onto the reference's topics.

Every derived topic is a projection of a whole driver table; nothing is
sampled.  Join misses, null genders and tombstones come from data attributes
so that the edge paths of the operators run on real rows:

* ``orders``  := lineitem JOIN orders (one order record per line item),
  user = customer key, item = part key, time = order date, quantity.
* ``users``   := all customers; address = nation, gender by key parity and
  null for nation 0, age 15..44 from the key.  One order line in 11 names a
  user who is none of them.
* ``items``   := all parts; address = one of 25 regions by key, type = p_type,
  price = p_retailprice.  One order line in 13 names another item.
* ``log``     := events as a keyed topic log (key user id, JSON value, three
  hash partitions, consecutive offsets, ``delaySeconds`` headers).
* ``changelog`` := events as a user-keyed changelog; ``error`` events are
  tombstones.
* ``words``   := document texts (whole) and timed event words.

The SQL twins of these views live in :mod:`topicflow.plans.sqlviews`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from topicflow.schemas import TOPIC_PARTITIONS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ts_ms(c) -> "F.Column":
    """timestamp_ntz (read as UTC) -> epoch milliseconds."""
    return F.unix_millis(F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp"))


def _miss(share: int) -> "F.Column":
    """Prefix that makes a key of one order line in ``share`` unknown."""
    return F.when((F.col("l_orderkey") + F.col("l_linenumber")) % share == 0, F.lit("X")).otherwise(F.lit(""))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order stream: ``user_name, item_name, transaction_date, quantity`` plus
    ``order_key, line_number`` which fix the arrival order (the offset).  One
    line in 11 names a user and one in 13 an item that is in no table; times
    lie within half an hour of the order's day, so windows hold several
    panes."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                                 "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.concat(_miss(11), F.col("o_custkey").cast("string")).alias("user_name"),
                    F.concat(_miss(13), F.col("l_partkey").cast("string")).alias("item_name"),
                    (ts_ms("o_orderdate") + F.pmod(F.col("l_orderkey") * 31 + F.col("l_linenumber") * 7, F.lit(360)) * 5000)
                    .alias("transaction_date"),
                    F.col("l_quantity").cast("int").alias("quantity"),
                    F.col("l_orderkey").alias("order_key"),
                    F.col("l_linenumber").alias("line_number")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("name"),
                    F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("address"),
                    F.when(F.col("c_nationkey") == 0, F.lit(None).cast("string"))
                     .when(F.col("c_custkey") % 2 == 0, F.lit("male"))
                     .otherwise(F.lit("female")).alias("gender"),
                    (F.lit(15) + F.col("c_custkey") % 30).cast("int").alias("age"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("item_name"),
                    F.concat(F.lit("N"), (F.col("p_partkey") % 25).cast("string")).alias("address"),
                    F.col("p_type").alias("type"),
                    F.col("p_retailprice").alias("price"))


def events_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as producer records, before partition/offset assignment:
    ``topic, key, value, timestamp, headers, event_id``.

    ``error`` events go to topic ``errors``, the rest to ``test`` (the topic
    the delayed-delivery consumer reads).  Header rule: ``click`` carries one
    ``delaySeconds`` of ``floor(value/4)``; ``view`` two (``floor(value/4)``
    and ``floor(value/8)``); ``signup`` an unparsable one; ``purchase`` and
    ``error`` none.
    """
    e = table(spark, sf_dir, "events")
    d4 = F.floor(F.col("value") / 4).cast("long").cast("string")
    d8 = F.floor(F.col("value") / 8).cast("long").cast("string")

    def h(v):
        return F.struct(F.lit("delaySeconds").alias("key"), F.encode(v, "UTF-8").alias("value"))

    empty = F.array().cast("array<struct<key:string,value:binary>>")
    headers = (F.when(F.col("event_type") == "click", F.array(h(d4)))
               .when(F.col("event_type") == "view", F.array(h(d4), h(d8)))
               .when(F.col("event_type") == "signup",
                     F.array(h(F.concat(F.lit("x"), F.col("event_id").cast("string")))))
               .otherwise(empty))
    return e.select(
        F.when(F.col("event_type") == "error", F.lit("errors")).otherwise(F.lit("test")).alias("topic"),
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
        F.encode(F.col("props"), "UTF-8").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        headers.alias("headers"),
        F.col("event_id"))


def placed_log(spark: SparkSession, sf_dir: str, n_partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """The events as produced: hash-placed (M1) and given consecutive offsets
    per partition in (timestamp, event id) order (M5), with ``event_id``."""
    from topicflow.operators.partitioning import assign_offsets, assign_partition
    rows = events_log_rows(spark, sf_dir)
    placed = assign_partition(rows, n_partitions, key_col=F.decode(F.col("key"), "UTF-8"))
    return assign_offsets(placed, order_cols=["timestamp", "event_id"]).withColumn("timestampType", F.lit(0))


_STORED_LOGS: dict[tuple, str] = {}


def log(spark: SparkSession, sf_dir: str, n_partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """The events topic log (Spark-Kafka schema) as consumers see it: a
    stored table.  Written once per application into the shared checkpoint
    folder, partitioned by topic and partition (so topic/partition filters
    prune directories, and lineage is cut), then read back."""
    from topicflow.sources.log import read_log
    return read_log(spark, log_path(spark, sf_dir, n_partitions))


def log_path(spark: SparkSession, sf_dir: str, n_partitions: int = TOPIC_PARTITIONS) -> str:
    """Where the stored log and its index lie; written if not there (any
    more)."""
    from topicflow.session import exists, scratch_path
    from topicflow.sources.log import write_log
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), n_partitions)
    path = _STORED_LOGS.get(key)
    if path is None or not exists(spark, f"{path}/_index"):
        path = scratch_path(spark, "events-log")
        write_log(placed_log(spark, sf_dir, n_partitions), path, mode="overwrite", index=True)
        _STORED_LOGS[key] = path
    return path


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User-keyed changelog of events: ``key, value, ts, seq``; ``error``
    events are tombstones (null value)."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("key"),
                    F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
                     .otherwise(F.col("props")).alias("value"),
                    F.col("ts").cast("timestamp").alias("ts"),
                    F.col("event_id").alias("seq"))


def profile_lookup(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events to look up (``event_id, key, ts, event_type``) and the
    changelog of user profiles (``key, value, ts, seq``): signups set, errors
    delete."""
    e = table(spark, sf_dir, "events")
    key, ts = F.col("user_id").cast("string").alias("key"), F.col("ts").cast("timestamp").alias("ts")
    rows = e.where(F.col("event_type").isin("click", "view", "purchase")).select("event_id", key, ts, "event_type")
    profile = F.when(F.col("event_type") == "error", F.lit(None).cast("string")).otherwise(F.col("props"))
    versions = e.where(F.col("event_type").isin("signup", "error")).select(key, profile.alias("value"), ts, F.col("event_id").alias("seq"))
    return rows, versions


def mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored topic with values of several classes: orders, items and
    users as JSON objects, per order of the driver table a bare object with
    its date, and per nation a text that is no JSON."""
    from topicflow.functions.codec import to_json_all_fields
    from topicflow.operators.partitioning import assign_partition
    from topicflow.schemas import ITEM_JSON_FIELDS, ORDER_JSON_FIELDS, USER_JSON_FIELDS
    from topicflow.session import scratch_path
    from topicflow.sources.log import keyed_json_records, read_log, write_log
    parts = [keyed_json_records(df, key, {j: c for c, j in fields.items()}, "mixed") for df, key, fields in (
        (orders(spark, sf_dir), "user_name", ORDER_JSON_FIELDS), (items(spark, sf_dir), "item_name", ITEM_JSON_FIELDS), (users(spark, sf_dir), "name", USER_JSON_FIELDS))]
    od, nation = table(spark, sf_dir, "orders"), table(spark, sf_dir, "nation")
    bare = to_json_all_fields({"id": F.col("o_orderkey"), "transactionDate": ts_ms("o_orderdate")})
    parts.append(od.select(F.lit("mixed").alias("topic"), F.encode(F.col("o_orderkey").cast("string"), "UTF-8").alias("key"), F.encode(bare, "UTF-8").alias("value")))
    parts.append(nation.select(F.lit("mixed").alias("topic"), F.encode(F.col("n_nationkey").cast("string"), "UTF-8").alias("key"), F.encode("n_name", "UTF-8").alias("value")))
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    path = scratch_path(spark, "mixed-log")
    write_log(assign_partition(log, TOPIC_PARTITIONS, key_col=F.decode(F.col("key"), "UTF-8")), path)
    return read_log(spark, path)


def timed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-count input records: ``value`` text and record ``timestamp``."""
    e = table(spark, sf_dir, "events")
    return e.select(F.concat_ws(" ", "event_type", "props").alias("value"),
                    F.col("ts").cast("timestamp").alias("timestamp"),
                    F.col("event_id").alias("seq"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts (whole)."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("value"))
