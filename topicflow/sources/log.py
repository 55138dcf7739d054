"""Topic log I/O (S1, S4, K1, K6): a topic is a table with the Spark-Kafka
schema.  Without a broker the log is a parquet dataset partitioned by
``topic`` and ``partition``; with one, the same schema comes from Spark's
Kafka source (the connector jar must be on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from topicflow.functions.codec import to_json_all_fields
from topicflow.schemas import LOG
from topicflow.sources.index import LogIndex


def read_log(spark: SparkSession, path: str, topics=None) -> DataFrame:
    """Batch read of a parquet log; topic filters prune directories."""
    df = spark.read.schema(LOG).parquet(path)
    if topics is not None:
        df = df.where(F.col("topic").isin(list(topics)))
    return df


def read_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A log as a stream (from the earliest file on)."""
    r = spark.readStream.schema(LOG)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def kafka_options(bootstrap: str, topics, starting: str = "earliest") -> dict:
    """Options for ``spark.read/readStream.format('kafka')``."""
    return {"kafka.bootstrap.servers": bootstrap,
            "subscribe": ",".join(topics) if not isinstance(topics, str) else topics,
            "startingOffsets": starting, "includeHeaders": "true"}


def write_log(df: DataFrame, path: str, mode: str = "append", index: bool = False) -> None:
    """K1: append records to the parquet log, laid out by topic/partition;
    with ``index``, its time and byte index is brought up to date."""
    cols = [f.name for f in LOG.fields]
    (df.select(*[F.col(c).cast(LOG[c].dataType) if c in df.columns else
                 F.lit(None).cast(LOG[c].dataType).alias(c) for c in cols])
       # one sorted run a task and partition: offset and time filters skip row groups
       .sortWithinPartitions("topic", "partition", "offset")
       .write.mode(mode).partitionBy("topic", "partition").parquet(path))
    if index:
        LogIndex(df.sparkSession, path).refresh()


def keyed_json_records(df: DataFrame, key_col: str, fields: dict, topic: str) -> DataFrame:
    """K6 + F7: ``(topic, key, value)`` with the value serialised as one JSON
    object holding every field (nulls included).  ``fields`` maps JSON name
    -> column name."""
    return df.select(F.lit(topic).alias("topic"),
                     F.encode(F.col(key_col), "UTF-8").alias("key"),
                     F.encode(to_json_all_fields({k: F.col(v) for k, v in fields.items()}),
                              "UTF-8").alias("value"))


def produce_tap(df: DataFrame, name: str = "produced") -> DataFrame:
    """Pass records through unchanged while counting them (records,
    key and value bytes) as a named observation, read after the action
    from ``pyspark.sql.Observation`` or the streaming progress."""
    return df.observe(name, F.count(F.lit(1)).alias("records"),
                      F.sum(F.coalesce(F.octet_length("key"), F.lit(0))).alias("key_bytes"),
                      F.sum(F.coalesce(F.octet_length("value"), F.lit(0))).alias("value_bytes"))


def console_sink(df: DataFrame, checkpoint: str, truncate: bool = False):
    """K4: print every record of a stream (console sink)."""
    return (df.writeStream.format("console").option("truncate", str(truncate).lower())
            .option("checkpointLocation", checkpoint))


def read_kafka(spark: SparkSession, bootstrap: str, topics, stream: bool = False,
               starting: str = "earliest") -> DataFrame:
    """S1/S4 on a broker: Spark's Kafka source gives exactly the log schema
    used here, so every operator runs on it unchanged.  Needs the
    spark-sql-kafka connector on the classpath (absent in this environment,
    hence untested here)."""
    opts = kafka_options(bootstrap, topics, starting)
    r = spark.readStream if stream else spark.read
    return r.format("kafka").options(**opts).load()


def write_kafka(df: DataFrame, bootstrap: str, topic: str | None = None):
    """K1 on a broker: ``key``/``value`` (and optional ``partition``,
    ``headers``, ``topic``) columns go to Spark's Kafka sink.  Returns the
    batch writer or, for a streaming frame, the stream writer."""
    w = df.writeStream if df.isStreaming else df.write
    w = w.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    if topic:
        w = w.option("topic", topic)
    return w
