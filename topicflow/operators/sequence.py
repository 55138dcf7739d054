"""Ordered numbering and running totals without a single-task window.

A log partition, a user or a topic may hold a third of all rows, so a window
``partition by key order by time`` over the whole key would pull that share
into one task.  Instead the rows are cut into ranges of equal size in the
order (keys, sort columns):

1. the rows are staged in the shared folder (the source is computed once:
   sampling and dealing read the staged rows), range-partitioned, numbered by
   range and staged again, so that range bounds stay what they were if a task
   runs again;
2. (key, range) totals — one row per range and key that meets it, so at most
   ranges + keys rows;
3. an exclusive prefix of those totals per key;
4. a window per (key, range) for the part inside, plus the prefix.

The result equals the one-window form exactly (for counts) and up to the
order of floating additions (for double sums).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from topicflow.session import scratch_path, staged

RANGE = _B = "__range"


def in_ranges(df: DataFrame, order_cols: Sequence) -> DataFrame:
    """``df`` in ranges of about equal size of ``order_cols``, numbered in
    the column RANGE, as a stored table."""
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = staged(df, "unranged")
    path = scratch_path(spark, "ranges")
    df.repartitionByRange(ranges, *order_cols).withColumn(_B, F.spark_partition_id()).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(T.StructType([*df.schema.fields, T.StructField(_B, T.IntegerType())])).parquet(path)


def _two_level(df: DataFrame, keys: Sequence[str], order_cols: Sequence,
               values: dict[str, Column], counting: bool) -> DataFrame:
    d = in_ranges(df.select("*", *[c.alias(f"__v_{n}") for n, c in values.items()]), [*keys, *order_cols])
    inside = Window.partitionBy(*keys, _B).orderBy(*order_cols)
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    whole = {n: F.count(F.lit(1)) if counting else F.sum(f"__v_{n}") for n in values}
    base = (d.groupBy(*keys, _B).agg(*[c.alias(f"__t_{n}") for n, c in whole.items()])
            .select(*keys, _B, *[F.sum(f"__t_{n}").over(before).alias(f"__b_{n}") for n in values]))
    w = d.select("*", *[(F.row_number().over(inside) if counting else F.sum(f"__v_{n}").over(run)).alias(f"__in_{n}") for n in values])
    # null keys are a key like any other
    at = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, _B)]
    out = w.alias("l").join(base.alias("r"), reduce(Column.__and__, at))
    return out.select(*[F.col(f"l.{c}") for c in df.columns], *[
        F.when(F.col(f"__b_{n}").isNull(), F.col(f"__in_{n}"))
         .otherwise(F.col(f"__b_{n}") + F.col(f"__in_{n}")).alias(n) for n in values])


def row_numbers(df: DataFrame, keys: Sequence[str], order_cols: Sequence, name: str = "seq", start: int = 0) -> DataFrame:
    """Consecutive numbers ``start, start+1, ...`` per ``keys`` in
    ``order_cols`` order (a distributed ``zipWithIndex``)."""
    r = _two_level(df, keys, order_cols, {name: F.lit(1)}, counting=True)
    return r.withColumn(name, (F.col(name) - 1 + F.lit(start)).cast("long"))


def running_sums(df: DataFrame, keys: Sequence[str], order_cols: Sequence, values: dict[str, Column]) -> DataFrame:
    """Inclusive running sums of ``values`` per ``keys`` in ``order_cols``
    order; one output column per entry of ``values``."""
    return _two_level(df, keys, order_cols, values, counting=False)
