import random

import pytest
from pyspark.sql import functions as F

from topicflow.operators import offsets
from topicflow.sources.index import LogIndex
from topicflow.sources.log import read_log, write_log

BASE = 1_700_000_000_000


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """Three partitions, times partly out of order, offsets from 100 on,
    written in two appends, indexed after each."""
    path, r = str(tmp_path_factory.mktemp("log")), random.Random(4)
    rows = []
    for topic, partition, n in (("a", 0, 900), ("a", 1, 400), ("b", 0, 3)):
        for k in range(n):
            rows.append((topic, partition, 100 + k, "k" * r.randint(0, 4), "v" * r.randint(0, 9) if k % 7 else None, BASE + k * 1000 + r.choice([0, 0, 40_000, -30_000])))
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value string, ms long").select(
        "topic", "partition", "offset", F.encode("key", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value"),
        F.timestamp_millis("ms").alias("timestamp"))
    for part in ("offset < 450", "offset >= 450"):
        write_log(df.where(part).repartitionByRange(3, "topic", "partition", "offset"), path)
        LogIndex(spark, path, segment=64).refresh()
    return path


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_lookups_equal_the_scans(spark, log):
    index, whole = LogIndex(spark, log, segment=64), read_log(spark, log)
    assert index.rows().agg(F.sum("records")).first()[0] == whole.count() == 1303
    assert _rows(index.topic_summary()) == _rows(offsets.topic_summary(whole))
    for t in (BASE - 50_000, BASE + 100_000, BASE + 333_333, BASE + 700_500, BASE + 10_000_000):
        assert _rows(index.offsets_for_times(t)) == _rows(offsets.offsets_for_times(whole, t)), t
        assert _rows(index.offsets_before(t)) == _rows(offsets.offsets_before(whole, t)), t
        assert _rows(index.replay_since(t).select("topic", "partition", "offset")) == _rows(offsets.replay_since(whole, t).select("topic", "partition", "offset")), t
    for start, limit in ((0, 500), (130, 0), (130, 77), (500, 100_000), (5000, 10)):
        got = index.bounded_fetch("a", 0, start, limit)
        assert _rows(got.select("offset", "fetched_bytes")) == _rows(offsets.bounded_fetch(whole, "a", 0, start, limit).select("offset", "fetched_bytes"))
    assert index.bounded_fetch("nope").count() == 0 and index.offsets_for_times(BASE, "nope").count() == 0


def test_little_is_read(spark, log):
    """Times: the segments around the answer; bytes: those up to the limit;
    offsets are literals in the scans."""
    index = LogIndex(spark, log, segment=64)
    _, ranges = index._time_ranges(F.timestamp_millis(F.lit(BASE + 333_333)), None)
    assert len(ranges) == 2 and all(hi - lo < 3 * 64 for _, _, lo, hi in ranges)
    replay = index.replay_since(BASE + 700_500)
    plan = replay._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset," in plan and "topic" in plan
    fetch = index.bounded_fetch("a", 0, 130, 77)
    plan = fetch._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(offset,255)" in plan and "GreaterThanOrEqual(offset,130)" in plan


def test_empty_log(spark, tmp_path):
    empty = spark.createDataFrame([], "topic string, partition int, offset long, key binary, value binary, timestamp timestamp")
    write_log(empty, f"{tmp_path}/log", index=True)
    index = LogIndex(spark, f"{tmp_path}/log")
    assert index.newest() is None and index.topic_summary().count() == 0
    assert index.replay_since(0).count() == 0 and index.bounded_fetch("a").count() == 0 and index.offsets_before(0).count() == 0
