"""Bounded, incremental runs of a streaming query over a staged topic.

A topic is staged as parquet in the shared checkpoint folder in ``n_chunks``
time-ordered appends (one write job each, many files per chunk, nothing
funnelled through one task).  After each append the query is (re)started
with ``trigger(availableNow=True)`` on the same checkpoint, so it catches up
on the new files only — the way a job restarted against a growing topic
behaves, and a check that state and offsets survive a restart.

Event-time queries in ``append`` mode emit a window only once the watermark
has passed it; ``close_after`` appends one record at the end, later than all
others by that much, so that the final windows close.  It is told apart by
the boolean column ``END`` of the staged topic, never by its values, and
:func:`without_end` takes it out after the watermark has seen it.

Sinks: ``append`` uses the exactly-once parquet file sink; ``update`` writes
each micro-batch's changed rows into a compacted table (a batch rewrites the
buckets of its keys only; idempotent on retry), which is the result.
"""

from __future__ import annotations

import contextlib
import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from topicflow.session import scratch_path
from topicflow.streaming.slots import CompactedTable


@contextlib.contextmanager
def state_partitions(spark: SparkSession):
    """Number of state-store partitions of a new stateful query.

    It is fixed in the checkpoint at the first start, from
    ``spark.sql.shuffle.partitions``.  When the application did not
    configure that setting, Spark's default (200) is unrelated to the
    cluster; use the cluster's parallelism instead (all cores, so it grows
    with the executors).  An explicit setting is left alone."""
    key = "spark.sql.shuffle.partitions"
    if spark.sparkContext.getConf().contains(key):
        yield
        return
    old = spark.conf.get(key)
    spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


END = "__end"


def without_end(stream: DataFrame) -> DataFrame:
    """Drop the closing record of a stream with a watermark.  The optimizer
    moves conditions on other columns (also those that it infers from joins)
    below the watermark, where the record would be gone before its time is
    seen; it does not move them through a projection that is not
    deterministic, so one stands here."""
    return stream.withColumn("__stay", F.rand(0)).where(~F.col(END) & (F.col("__stay") >= 0)).drop(END, "__stay")


def _bounds(df: DataFrame, order_col: str):
    r = df.agg(F.min(order_col).alias("lo"), F.max(order_col).alias("hi")).first()
    return r["lo"], r["hi"]


def _chunk_filter(order_col: str, lo, hi, i: int, n: int) -> Column:
    c = F.col(order_col)
    if lo is None:
        return F.lit(i == 0)
    if i == 0:  # rows without an order value come first
        return c.isNull() | _chunk_filter(order_col, lo, hi, -1, n)
    i = max(i, 0)
    if hasattr(lo, "timestamp"):
        a = F.unix_micros(c.cast("timestamp"))
        lo_v, hi_v = int(lo.timestamp() * 1e6), int(hi.timestamp() * 1e6)
    else:
        a, lo_v, hi_v = c, lo, hi
    step = (hi_v - lo_v) // n + 1
    start, end = lo_v + i * step, lo_v + (i + 1) * step
    return (a >= F.lit(start)) & (a < F.lit(end)) if i < n - 1 else (a >= F.lit(start))


def run_bounded(spark: SparkSession, name: str, source: DataFrame, order_col: str,
                build: Callable[[DataFrame], DataFrame], mode: str = "append",
                key: str | None = None, n_chunks: int = 2,
                close_after: datetime.timedelta | None = None, root: str | None = None,
                foreach: Callable[[DataFrame, int], None] | None = None, stateful: bool = True) -> str:
    """Stage ``source`` chunk by chunk, run ``build(stream)`` after each, and
    return the output path (see module doc).  ``key`` is the result's key
    for ``mode='update'``; ``foreach`` takes each micro-batch of an append
    query instead of the file sink.  A query without state store
    (``stateful=False``) keeps the session's number of shuffle partitions."""
    root = root or scratch_path(spark, f"stream-{name}")
    partitions = state_partitions if stateful else contextlib.nullcontext
    inp, ckpt, out = f"{root}/input", f"{root}/checkpoint", f"{root}/output"
    lo, hi = _bounds(source, order_col)
    if close_after is not None:
        source = source.withColumn(END, F.lit(False))
    schema = source.schema

    def run_once():
        stream = spark.readStream.schema(schema).parquet(inp)
        res = build(stream)
        w = res.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
        if foreach is not None:
            q = w.outputMode("append").foreachBatch(foreach).start()
        elif mode == "append":
            q = w.outputMode("append").format("parquet").option("path", out).start()
        elif mode == "update":
            table = updated_table(spark, out, res.schema, key)

            def sink(batch: DataFrame, batch_id: int):
                table.merge(batch.withColumn(_BATCH, F.lit(batch_id)), batch_id)
            q = w.outputMode("update").foreachBatch(sink).start()
        else:
            raise ValueError(mode)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()

    for i in range(n_chunks):
        source.where(_chunk_filter(order_col, lo, hi, i, n_chunks)).write.mode("append").option("compression", "zstd").parquet(inp)
        with partitions(spark):
            run_once()
    if close_after is not None and hi is not None:
        last = {order_col: hi + close_after, END: True}
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        spark.createDataFrame([tuple(last.get(f.name) for f in schema)], nullable).write.mode("append").parquet(inp)
        with partitions(spark):
            run_once()
    return out


_BATCH = "__batch"


def updated_table(spark: SparkSession, out: str, schema: T.StructType, key: str) -> CompactedTable:
    """The result table of an update-mode run: a key's row is the last one
    written."""
    whole = T.StructType([*schema.fields, T.StructField(_BATCH, T.IntegerType())])
    return CompactedTable(spark, out, whole, key, [_BATCH], [f.name for f in schema.fields if f.name != key])


def read_result(spark: SparkSession, out: str) -> DataFrame:
    """The rows that an append run of :func:`run_bounded` wrote."""
    return spark.read.parquet(out)
