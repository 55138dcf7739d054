"""Delayed delivery (W8): records carry ``delaySeconds`` headers; a consumer
rewinds to ``now - lookback`` and delivers a record once per header whose
delay has elapsed (ST5, F9, K7, F10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from topicflow.functions.codec import header_long, make_header
from topicflow.operators.offsets import replay_since
from topicflow.schemas import (DELAY_HEADER, DELAY_LOOKBACK_S, DELAY_TOPIC,
                               PAYLOAD_TIME_FORMAT)


def delay_encode(df: DataFrame, delay_col, ts_col: str = "timestamp", key_col="key") -> DataFrame:
    """K7 + F10: a produced record whose payload is the send time rendered
    ``yyyy-MM-dd HH:mm:ss:SSS`` and which carries one ``delaySeconds``
    header."""
    d = F.col(delay_col) if isinstance(delay_col, str) else delay_col
    return df.select(F.col(key_col).alias("key"),
                     F.encode(F.date_format(F.col(ts_col), PAYLOAD_TIME_FORMAT), "UTF-8").alias("value"),
                     F.col(ts_col).alias("timestamp"),
                     F.array(make_header(DELAY_HEADER, d)).alias("headers"))


def due_messages(log: DataFrame, now_ms, lookback_s: int = DELAY_LOOKBACK_S,
                 topic: str = DELAY_TOPIC, header: str = DELAY_HEADER,
                 observe_as: str | None = None) -> DataFrame:
    """ST5 (batch, one consumer pass at time ``now_ms``): rewind every
    partition to the first offset at/after ``now - lookback`` (S7), keep the
    records of ``topic`` (P8) and emit a record once for every ``header``
    whose value ``d`` is > 0 with ``now - timestamp >= d`` seconds.  A header
    that is not a number drops that header (the reference throws);
    ``observe_as`` counts them as a named observation."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    since = F.timestamp_millis(now - F.lit(lookback_s * 1000))
    return due_of(replay_since(log.where(F.col("topic") == topic), since), now, header, observe_as)


def due_of(rows: DataFrame, now_ms, header: str = DELAY_HEADER, observe_as: str | None = None) -> DataFrame:
    """The due headers of ``rows`` at ``now_ms`` (see :func:`due_messages`)."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    hx = rows.select("*", F.posexplode("headers").alias("header_pos", "h")) \
             .where(F.col("h.key") == header)
    hx = hx.withColumn("delay_seconds", header_long(F.col("h.value")))
    if observe_as:
        hx = hx.observe(observe_as, F.count(F.when(F.col("delay_seconds").isNull(), 1))
                        .alias("bad_headers"))
    # whole seconds of age: no product that a large delay could overflow
    age_s = F.floor((now - F.unix_millis(F.col("timestamp"))) / F.lit(1000))
    return hx.where((F.col("delay_seconds") > 0) & (age_s >= F.col("delay_seconds"))).drop("h")
