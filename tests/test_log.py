"""Log metadata, positioned reads and delayed delivery (FIXTURES.md §4)."""

import datetime as dt

from pyspark.sql import functions as F

from topicflow.operators import delay, offsets, partitioning
from topicflow.schemas import LOG

NOW = 1_700_000_000_000
T0 = dt.datetime(2023, 11, 14, 22, 13, 20, tzinfo=dt.timezone.utc)  # == NOW


def _rec(topic, part, off, age_s, headers, key="k"):
    ts = dt.datetime.fromtimestamp((NOW - age_s * 1000) / 1000, tz=dt.timezone.utc)
    return (key.encode(), f"v{off}".encode(), topic, part, off, ts, 0,
            [(h, v.encode()) for h, v in headers])


def _log(spark, rows):
    return spark.createDataFrame(rows, LOG)


def test_delay_cases(spark):
    d = "delaySeconds"
    rows = [_rec("test", 0, 0, 190, [(d, "120")]),    # older than the look-back, before the start
            _rec("test", 0, 1, 150, [(d, "120")]),
            _rec("test", 0, 2, 121, [(d, "120")]),
            _rec("test", 0, 3, 120, [(d, "120")]),    # inclusive
            _rec("test", 0, 4, 119, [(d, "120")]),
            _rec("test", 0, 5, 150, []),
            _rec("test", 0, 6, 150, [(d, "0")]),
            _rec("test", 0, 7, 150, [(d, "-5")]),
            _rec("test", 0, 8, 150, [(d, "60"), (d, "120")]),
            _rec("test", 0, 9, 150, [(d, "abc")]),
            _rec("test", 0, 10, 190, [(d, "120")]),   # old timestamp, but after the start offset
            _rec("other", 0, 0, 150, [(d, "120")])]
    got = delay.due_messages(_log(spark, rows), NOW, observe_as="bad").collect()
    offs = sorted(r.offset for r in got)
    assert offs == [1, 2, 3, 8, 8, 10]
    assert all(r.topic == "test" for r in got)


def test_offsets_and_replay(spark):
    rows = [_rec("t", p, o, 1000 - 100 * o, []) for p in (0, 1) for o in range(5)]
    log = _log(spark, rows)
    t = F.timestamp_millis(F.lit(NOW - 650 * 1000))
    fft = {(r.partition): r.offset for r in offsets.offsets_for_times(log, t).collect()}
    assert fft == {0: 4, 1: 4}
    ob = {(r.partition): r.offset for r in offsets.offsets_before(log, t).collect()}
    assert ob == {0: 4, 1: 4}
    assert {r.partition: r.offset for r in offsets.offsets_before(log).collect()} == {0: 5, 1: 5}
    assert offsets.replay_since(log, t).count() == 2
    none = offsets.offsets_for_times(log, F.timestamp_millis(F.lit(NOW + 1)))
    assert [r.offset for r in none.collect()] == [None, None]
    assert offsets.replay_since(log, F.timestamp_millis(F.lit(NOW + 1))).count() == 0
    s = {r.partition: (r.first_offset, r.end_offset, r.records) for r in offsets.topic_summary(log).collect()}
    assert s == {0: (0, 5, 5), 1: (0, 5, 5)}
    assert {r.partition: r.next_offset for r in offsets.committed_offsets(log).collect()} == {0: 5, 1: 5}
    assert offsets.pause_partitions(log, (0,)).count() == 5


def test_bounded_fetch(spark):
    rows = [_rec("t", 0, o, 10, []) for o in range(10)]   # key 1 byte + value 2 bytes
    f = offsets.bounded_fetch(_log(spark, rows), "t", 0, 2, 10)
    assert sorted(r.offset for r in f.collect()) == [2, 3, 4]


def test_assign_offsets_and_round_robin(spark):
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(f"k{i % 3}", base + dt.timedelta(minutes=37 * i), i) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, timestamp timestamp, id int") \
        .withColumn("topic", F.lit("t"))
    placed = partitioning.assign_partition(df, 3, "key")
    off = partitioning.assign_offsets(placed, ["timestamp", "id"]).collect()
    by_part = {}
    for r in sorted(off, key=lambda r: r.id):
        by_part.setdefault(r.partition, []).append(r.offset)
    for lst in by_part.values():
        assert lst == list(range(len(lst)))
    rr = partitioning.round_robin_partition(df, ["timestamp", "id"]).collect()
    assert {r.id: r.partition for r in rr} == {i: (i + 1) % 3 for i in range(200)}


def test_delivery_report(spark):
    rows = [_rec("t", 0, 0, 1, [], key="abc")]
    r = offsets.delivery_report(_log(spark, rows)).first()
    assert (r.key_size, r.value_size) == (3, 2)


def test_long_and_overflowing_delays(spark):
    """A header of 29 digits is a number; the largest delay is never due and
    fails nothing."""
    d = "delaySeconds"
    rows = [_rec("test", 0, 0, 150, [(d, "0" * 27 + "60")]), _rec("test", 0, 1, 150, [(d, "9223372036854775807")]),
            _rec("test", 0, 2, 150, [(d, "92233720368547758070")])]
    got = delay.due_messages(_log(spark, rows), NOW).select("offset", "delay_seconds").collect()
    assert [tuple(r) for r in got] == [(0, 60)]
