"""Log metadata and positioned reads over a topic log table (S6-S8, K8, K9,
L1-L3).  The log has the Spark-Kafka schema; positions are per
(topic, partition) offsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from topicflow.schemas import BOUNDED_FETCH_BYTES, PAUSED_PARTITIONS

TP = ["topic", "partition"]
OFFSET_BUCKET = 1 << 16


def _ts(t) -> Column:
    """A time bound given as epoch ms (int), a timestamp or a Column."""
    if isinstance(t, Column):
        return t
    if isinstance(t, int):
        return F.timestamp_millis(F.lit(t))
    return F.lit(t).cast("timestamp")


def topic_summary(log: DataFrame) -> DataFrame:
    """L3: partitions of each topic with first offset, end offset, count."""
    return log.groupBy(*TP).agg(F.min("offset").alias("first_offset"),
                                (F.max("offset") + 1).alias("end_offset"),
                                F.count(F.lit(1)).alias("records"))


def committed_offsets(consumed: DataFrame) -> DataFrame:
    """K9: the offset a consumer commits after processing ``consumed``: the
    next offset to read, per partition."""
    return consumed.groupBy(*TP).agg((F.max("offset") + 1).alias("next_offset"))


def offsets_for_times(log: DataFrame, t) -> DataFrame:
    """L2: per partition, the first offset whose timestamp is at or after
    ``t`` (null when there is none)."""
    # the flag is a column of its own: ``t`` may be a scalar subquery, which
    # Spark does not accept inside an aggregate's arguments
    flagged = log.withColumn("__in", F.col("timestamp") >= _ts(t))
    return flagged.groupBy(*TP).agg(F.min(F.when(F.col("__in"), F.col("offset"))).alias("offset"))


def offsets_before(log: DataFrame, t=None) -> DataFrame:
    """L1: per partition, the offset just after the last record before ``t``
    (``t=None``: the latest offset, i.e. the log end).  With no record before
    ``t`` the partition's first offset is returned."""
    if t is None:
        return log.groupBy(*TP).agg((F.max("offset") + 1).alias("offset"))
    flagged = log.withColumn("__before", F.col("timestamp") < _ts(t))
    return flagged.groupBy(*TP).agg(F.coalesce(
        F.max(F.when(F.col("__before"), F.col("offset"))) + 1,
        F.min("offset")).alias("offset"))


def replay_since(log: DataFrame, t) -> DataFrame:
    """Rewind each partition to its first offset at/after ``t`` and read
    from there (by offset, so a later offset with an older timestamp is
    read too).  A partition without such an offset keeps its position at the
    end and yields nothing."""
    start = offsets_for_times(log, t).where(F.col("offset").isNotNull()) \
        .withColumnRenamed("offset", "__start")
    return log.join(start, TP).where(F.col("offset") >= F.col("__start")).drop("__start")


def pause_partitions(log: DataFrame, paused: Sequence[int] = PAUSED_PARTITIONS,
                     topics: Sequence[str] | None = None, first_poll: int = 0) -> DataFrame:
    """Records delivered when ``paused`` partitions stop delivering after
    the first poll, which still returns the first ``first_poll`` records of
    every partition."""
    cond = ~F.col("partition").isin(list(paused)) | (F.col("offset") < first_poll)
    if topics is not None:
        cond = cond | ~F.col("topic").isin(list(topics))
    return log.where(cond)


def record_bytes() -> Column:
    """Key + value size of a record (a null part counts 0)."""
    return (F.coalesce(F.octet_length("key"), F.lit(0)) +
            F.coalesce(F.octet_length("value"), F.lit(0))).cast("long")


def bounded_fetch(log: DataFrame, topic: str, partition: int = 0, start_offset: int = 0,
                  max_bytes: int = BOUNDED_FETCH_BYTES) -> DataFrame:
    """One fetch of one partition from ``start_offset``: the records that
    fit completely in ``max_bytes`` (key + value bytes), in offset order.
    Byte sums per offset bucket (combined map-side) give each bucket's start;
    the running count is computed only in the buckets that start below the
    limit, so little more than the fetched records is sorted."""
    part = log.where((F.col("topic") == topic) & (F.col("partition") == partition) &
                     (F.col("offset") >= start_offset))
    bucket = F.floor(F.col("offset") / F.lit(OFFSET_BUCKET)).cast("long")
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (part.groupBy(bucket.alias("__bucket")).agg(F.sum(record_bytes()).alias("__b"))
              .withColumn("__start", F.coalesce(F.sum("__b").over(before), F.lit(0)))
              .where(F.col("__start") <= max_bytes).select("__bucket", "__start"))
    inside = Window.partitionBy("__bucket").orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = (part.withColumn("__bucket", bucket).join(starts, "__bucket")
           .withColumn("fetched_bytes", F.col("__start") + F.sum(record_bytes()).over(inside)))
    return run.where(F.col("fetched_bytes") <= max_bytes).drop("__bucket", "__start")


def delivery_report(sent: DataFrame) -> DataFrame:
    """K8: per produced record: topic, partition, offset and the serialised
    key / value sizes (-1 for a null key or value, as the client reports)."""
    def size(c):
        return F.when(F.col(c).isNull(), F.lit(-1)).otherwise(F.octet_length(c)).cast("int")
    return sent.select(*TP, "offset", size("key").alias("key_size"),
                       size("value").alias("value_size"))
