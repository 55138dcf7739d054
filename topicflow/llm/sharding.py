"""Shards of near-equal bytes by Karmarkar-Karp differencing.

Documents with equal texts form a group that stays together.  Groups holding
at least 1/``items`` of all bytes (at most ``items`` of them) are items of
their own; all other groups are hashed into ``items`` bundles.  So at most
2 * ``items`` sums reach the driver, whatever the corpus, and differencing
over them gives every item its shard.
"""

from __future__ import annotations

import heapq
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, staged

ITEMS = 4096


def differencing(sizes, shards: int) -> list[int]:
    """Shard of each size by multiway Karmarkar-Karp: a partial partition is
    ``shards`` sums with their members; the two of largest spread are
    combined oppositely ordered until one is left."""
    number = count()
    heap = []
    for k, size in enumerate(sizes):
        parts = [(size, [k]), *((0, []) for _ in range(shards - 1))]  # largest sum first
        heapq.heappush(heap, (-size, next(number), parts))
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        parts = []
        for (x, members), (y, more) in zip(a, reversed(b)):
            if len(members) < len(more):
                members, more = more, members
            members.extend(more)
            parts.append((x + y, members))
        parts.sort(key=lambda p: -p[0])
        heapq.heappush(heap, (parts[-1][0] - parts[0][0], next(number), parts))
    shard = [0] * len(sizes)
    for s, (_, members) in enumerate(heap[0][2] if heap else []):
        for k in members:
            shard[k] = s
    return shard


def shards(spark: SparkSession, docs: DataFrame, n_shards: int = 8, items: int = ITEMS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of all
    documents under the law ``bytes``: shard sizes as equal as differencing
    makes them with equal texts kept together (a null text counts as the
    empty one).  Slots run gapless from 0 in each shard, in no meant order.
    Repeated rows take a slot each; an empty table gives no rows; columns
    other than doc_id and text are not read."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = staged(spark, docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("group_key")), "sizes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    bundle = F.pmod(F.xxhash64("group_key"), F.lit(items))
    large = F.col("bytes") * items >= F.lit(total)
    sums = (rows.groupBy("group_key").agg(F.sum("size").alias("bytes"))
            .select("bytes", F.when(large, F.col("group_key")).alias("large_key"), F.when(~large, bundle).alias("bundle"))
            .groupBy("large_key", "bundle").agg(F.sum("bytes").alias("bytes")).collect())
    sums.sort(key=lambda r: (-r.bytes, r.large_key or "", r.bundle or 0))
    shard_of = differencing([r.bytes for r in sums], n_shards)
    by_key = spark.createDataFrame([(r.large_key, s) for r, s in zip(sums, shard_of) if r.large_key], "group_key string, own_shard int")
    by_bundle = spark.createDataFrame([(r.bundle, s) for r, s in zip(sums, shard_of) if not r.large_key], "bundle long, bundle_shard int")
    placed = (rows.withColumn("bundle", bundle)
              .join(F.broadcast(by_key), "group_key", "left")        # both at most ``items`` rows
              .join(F.broadcast(by_bundle), "bundle", "left")
              .select("doc_id", "size", "text_crc32", F.coalesce("own_shard", "bundle_shard").alias("shard")))
    return (numbered(placed, ["shard"], ["doc_id", "size", "text_crc32"], "slot")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
