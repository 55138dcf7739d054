"""Sinks and taps: K1 log write/read, K4 foreach, K5 placement, K6/F7
codec, K10 produce tap."""

import datetime as dt

from pyspark.sql import Observation, functions as F, types as T

from topicflow.functions.codec import from_json_strict, to_json_all_fields
from topicflow.operators import partitioning
from topicflow.session import scratch_path
from topicflow.sources import log as logio


def test_placement_by_partition_column(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(60)], "key string")
    placed = partitioning.place(partitioning.assign_partition(df, 3, "key"), 3)
    bad = placed.where(F.spark_partition_id() != F.col("partition")).count()
    assert placed.rdd.getNumPartitions() == 3 and bad == 0


def test_log_roundtrip_and_tap(spark):
    ts = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    recs = spark.createDataFrame([("t", f"k{i}", f"v{i}", i % 3, i // 3, ts) for i in range(9)],
                                 "topic string, k string, v string, partition int, offset long, timestamp timestamp") \
        .select("topic", F.encode("k", "UTF-8").alias("key"), F.encode("v", "UTF-8").alias("value"),
                "partition", "offset", "timestamp")
    obs = Observation("produced")
    tapped = recs.observe(obs, F.count(F.lit(1)).alias("records"))
    path = scratch_path(spark, "log")
    logio.write_log(tapped, path)
    assert obs.get["records"] == 9
    back = logio.read_log(spark, path, topics=["t"])
    assert back.count() == 9 and back.where("partition = 1").count() == 3
    t2 = logio.produce_tap(back, "again")
    assert t2.count() == 9


def test_json_strict(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([(1, None)], "a long, b string")
    j = df.select(to_json_all_fields({"a": F.col("a"), "b": F.col("b")}).alias("j"))
    assert j.first().j == '{"a":1,"b":null}'
    assert j.select(from_json_strict("j", schema).alias("o")).first().o.a == 1
    bad = spark.createDataFrame([('{"a":1,"c":2}',)], "j string")
    try:
        bad.select(from_json_strict("j", schema)).collect()
        raised = False
    except Exception:  # noqa: BLE001
        raised = True
    assert raised


def test_foreach_sink(spark, tmp_path):
    inp = str(tmp_path / "in")
    spark.createDataFrame([("a",), ("b",)], "value string").write.parquet(inp)
    seen = []

    def each(batch, batch_id):
        seen.extend(r.value for r in batch.collect())   # K4: per-record side effect
    q = (spark.readStream.schema("value string").parquet(inp).writeStream
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True)
         .foreachBatch(each).start())
    q.awaitTermination()
    assert sorted(seen) == ["a", "b"]
    q2 = logio.console_sink(spark.readStream.schema("value string").parquet(inp), str(tmp_path / "ck2")) \
        .trigger(availableNow=True).start()
    q2.awaitTermination()
    assert q2.exception() is None
