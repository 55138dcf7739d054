"""Index of a stored topic log: lookups by time or bytes without a scan.

The index has one row per file and ``segment`` of offsets: the offsets, the
times and the bytes that lie in it.  It stands in a folder of the log that
readers of the log pass over, and is written after the log (only files that
it does not have yet are read).  A lookup finds the few segments that can
hold the answer and reads the log between literal offsets, which prune
folders, files and row groups; only index rows and one offset per partition
reach the driver.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from topicflow.schemas import BOUNDED_FETCH_BYTES, LOG
from topicflow.session import exists

TP = ["topic", "partition"]
SEGMENT = 4096
BRANCHES = 200      # partitions read by a union of literal ranges; more by one condition
_STEP = 64          # segments of one partition looked at a time
_ROWS = ("file string, segment long, first_offset long, last_offset long, first_ts timestamp, last_ts timestamp, "
         "records long, bytes long, topic string, partition int")


def record_bytes() -> Column:
    """Key + value size of a record (a null part counts 0)."""
    return (F.coalesce(F.octet_length("key"), F.lit(0)) + F.coalesce(F.octet_length("value"), F.lit(0))).cast("long")


class LogIndex:
    """The index of the log at ``path``; call :meth:`refresh` after writes."""

    def __init__(self, spark: SparkSession, path: str, segment: int = SEGMENT):
        self.spark, self.path, self.segment = spark, path.rstrip("/"), segment

    def rows(self) -> DataFrame:
        path = f"{self.path}/_index"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], _ROWS)
        return self.spark.read.schema(_ROWS).parquet(path)

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(self.path)

    def refresh(self) -> None:
        """Index the files that were written since."""
        log = self.log().withColumn("file", F.col("_metadata.file_path"))
        log = log.join(self.rows().select("file").distinct(), "file", "left_anti")
        segment = F.floor(F.col("offset") / F.lit(self.segment)).cast("long")
        (log.groupBy("file", segment.alias("segment"), *TP)
         .agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.min("timestamp").alias("first_ts"),
              F.max("timestamp").alias("last_ts"), F.count(F.lit(1)).alias("records"), F.sum(record_bytes()).alias("bytes"))
         .repartition(*TP).sortWithinPartitions(*TP, "segment")
         .write.mode("append").partitionBy(*TP).parquet(f"{self.path}/_index"))

    def between(self, ranges: list[tuple[str, int, int | None, int | None]]) -> DataFrame:
        """Records of (topic, partition, from offset, to offset); None: open."""
        log = self.log()
        if not ranges:
            return log.limit(0)

        def inside(topic, partition, lo, hi):
            at = (F.col("topic") == topic) & (F.col("partition") == partition)
            if lo is not None:
                at = at & (F.col("offset") >= F.lit(lo).cast("long"))
            return at if hi is None else at & (F.col("offset") <= F.lit(hi).cast("long"))

        if len(ranges) > BRANCHES:
            return log.where(reduce(Column.__or__, [inside(*r) for r in ranges]))
        return reduce(DataFrame.union, [log.where(inside(*r)) for r in ranges])

    def topic_summary(self) -> DataFrame:
        """L3 from the index alone."""
        return self.rows().groupBy(*TP).agg(F.min("first_offset").alias("first_offset"), (F.max("last_offset") + 1).alias("end_offset"),
                                            F.sum("records").alias("records"))

    def newest(self, topic: str | None = None) -> dt.datetime | None:
        """Time of the newest record, from the index alone."""
        rows = self.rows() if topic is None else self.rows().where(F.col("topic") == topic)
        return rows.agg(F.max("last_ts")).first()[0]

    def _time_ranges(self, t: Column, topic: str | None) -> tuple[DataFrame, list]:
        """Partitions, and where the first record at or after ``t`` lies: in
        a segment with such a record, not behind the first one that ends."""
        rows = self.rows() if topic is None else self.rows().where(F.col("topic") == topic)
        late = rows.where(F.col("last_ts") >= t)
        upto = late.groupBy(*TP).agg(F.min("last_offset").alias("hi"))
        found = late.join(upto, TP).where("first_offset <= hi").groupBy(*TP, "hi").agg(F.min("first_offset").alias("lo"))
        return rows.select(*TP).distinct(), [(r.topic, r.partition, r.lo, r.hi) for r in found.collect()]  # one a partition

    def offsets_for_times(self, t, topic: str | None = None) -> DataFrame:
        """L2: per partition, the first offset whose time is at or after
        ``t`` (epoch ms or a time); null where there is none."""
        t = time_literal(t)
        partitions, ranges = self._time_ranges(t, topic)
        first = self.between(ranges).where(F.col("timestamp") >= t).groupBy(*TP).agg(F.min("offset").alias("offset"))
        return partitions.join(first, TP, "left").select(*TP, "offset")

    def offsets_before(self, t, topic: str | None = None) -> DataFrame:
        """L1: per partition, the offset just after the last record before
        ``t``; the first offset where there is none."""
        t = time_literal(t)
        rows = self.rows() if topic is None else self.rows().where(F.col("topic") == topic)
        early = rows.where(F.col("first_ts") < t)
        since = early.groupBy(*TP).agg(F.max("first_offset").alias("lo"))
        found = early.join(since, TP).where("last_offset >= lo").groupBy(*TP, "lo").agg(F.max("last_offset").alias("hi"))
        ranges = [(r.topic, r.partition, r.lo, r.hi) for r in found.collect()]  # one a partition
        last = self.between(ranges).where(F.col("timestamp") < t).groupBy(*TP).agg((F.max("offset") + 1).alias("offset"))
        firsts = rows.groupBy(*TP).agg(F.min("first_offset").alias("first_offset"))
        return firsts.join(last, TP, "left").select(*TP, F.coalesce("offset", "first_offset").alias("offset"))

    def replay_since(self, t, topic: str | None = None) -> DataFrame:
        """Every partition rewound to its first offset at or after ``t``
        and read from there; one without such an offset yields nothing."""
        starts = self.offsets_for_times(t, topic).where("offset is not null").collect()  # one a partition
        return self.between([(r.topic, r.partition, r.offset, None) for r in starts])

    def bounded_fetch(self, topic: str, partition: int = 0, start_offset: int = 0, max_bytes: int = BOUNDED_FETCH_BYTES) -> DataFrame:
        """The records of one partition from ``start_offset`` that fit
        completely in ``max_bytes``, in offset order, with the bytes up to
        each.  Only the segments up to the one that passes the limit are
        read."""
        rows = (self.rows().where((F.col("topic") == topic) & (F.col("partition") == partition) & (F.col("last_offset") >= start_offset))
                .groupBy("segment").agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"), F.sum("bytes").alias("bytes")))
        last, total, after = None, 0, -1
        while total <= max_bytes:
            some = rows.where(F.col("segment") > after).orderBy("segment").limit(_STEP).collect()
            for r in some:
                if total <= max_bytes:
                    last, after = r.last_offset, r.segment
                    total += r.bytes if r.first_offset >= start_offset else 0
            if len(some) < _STEP:
                break
        part = self.between([] if last is None else [(topic, partition, start_offset, last)])
        running = Window.partitionBy(*TP).orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return part.withColumn("fetched_bytes", F.sum(record_bytes()).over(running)).where(F.col("fetched_bytes") <= max_bytes)


def time_literal(t) -> Column:
    """Epoch ms or a time as a literal."""
    return F.timestamp_millis(F.lit(t).cast("long")) if isinstance(t, int) else F.lit(t).cast("timestamp")
