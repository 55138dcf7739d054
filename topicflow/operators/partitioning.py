"""Partition placement (M1-M5) and the write-through repartition (K5).

Placement is an expression column; physical placement, when wanted, uses
``repartitionById`` with that column, so Spark puts row ``r`` into output
partition ``r.partition`` without an extra hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from topicflow.functions.java import hash_partition_abs, hash_partition_mask
from topicflow.operators.sequence import row_numbers
from topicflow.schemas import TOPIC_PARTITIONS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def assign_partition(df: DataFrame, n: int = TOPIC_PARTITIONS, key_col="key",
                     rule: str = "mask", key_type: str = "string",
                     out: str = "partition") -> DataFrame:
    """Add the producer's partition choice.

    ``rule``: ``mask`` (M1, stream partitioner of the 0.10 code),
    ``abs`` (M2, 0.8 hash partitioner).  Random and round-robin placement are
    :func:`random_partition` and :func:`round_robin_partition`."""
    k = _c(key_col)
    if rule == "mask":
        p = hash_partition_mask(k, n, key_type)
    elif rule == "abs":
        p = hash_partition_abs(k, n, key_type)
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return df.withColumn(out, p)


def random_partition(df: DataFrame, n: int = TOPIC_PARTITIONS, seed: int | None = None,
                     out: str = "partition") -> DataFrame:
    """M3: uniform ``nextInt(n)``."""
    return df.withColumn(out, F.floor(F.rand(seed) * n).cast("int"))


def round_robin_partition(df: DataFrame, order_cols, n: int = TOPIC_PARTITIONS, out: str = "partition") -> DataFrame:
    """M4: a producer-wide counter, incremented before use, so the k-th sent
    record (0-based, in ``order_cols`` order) goes to ``(k+1) mod n``.

    The send sequence is numbered distributedly (:func:`row_numbers`), never
    in one task.  Beyond 2^31 records the reference's
    int cast turns negative; we keep ``pmod`` so every partition is valid."""
    numbered = row_numbers(df, [], order_cols, name="__send_seq", start=1)
    return numbered.withColumn(out, F.pmod(F.col("__send_seq"), F.lit(n)).cast("int")) \
                   .drop("__send_seq")


def assign_offsets(df: DataFrame, order_cols, partition_cols=("topic", "partition")) -> DataFrame:
    """M5: the broker gives consecutive offsets from 0 per topic partition, in
    arrival order (``order_cols``)."""
    return row_numbers(df, list(partition_cols), order_cols, name="offset")


def place(df: DataFrame, n: int, partition_col: str = "partition") -> DataFrame:
    """K5 write-through placement: row goes to physical partition
    ``partition_col`` (already in ``[0, n)``)."""
    return df.repartitionById(n, F.col(partition_col))
