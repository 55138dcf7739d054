"""Connected components of link tables, and a grouping helper for tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long) that is not
    the smallest of its component; component is that smallest node.

    Alternates large-star and small-star steps until nothing changes; each
    step is a map-side combined minimum and a join, staged in the shared
    folder, so no neighbourhood is ever gathered in one task."""

    def summary(e):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = staged(spark, links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    now = summary(edges)
    while now[0]:
        both = edges.union(edges.select("v", "u"))
        least = staged(spark, both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m")), "least")
        large = staged(spark, both.join(least, both.u == least.x).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = staged(spark, large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x"), "least")
        small = large.join(least, large.u == least.x).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(spark, small.union(least.select("x", "m")).distinct(), "edges")
        before, now = now, summary(edges)
        if before == now:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def runs_of(batches, key: str):
    """Runs of rows with equal ``key`` in a partition sorted by it, as
    (key, record batch); a run may span batches."""
    held, held_key = [], None

    def joined():
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, stop in zip(cuts, cuts[1:]):
            if held and keys[start] != held_key:
                yield held_key, joined()
                held = []
            held_key = keys[start]
            held.append(batch.slice(start, stop - start))
    if held:
        yield held_key, joined()


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the pairs (a, b) among ``n`` indexes."""
    label = np.arange(n)
    while True:
        m = np.minimum(label[a], label[b])
        if (label[a] == m).all() and (label[b] == m).all():
            return label
        np.minimum.at(label, a, m)
        np.minimum.at(label, b, m)
        label = label[label]
