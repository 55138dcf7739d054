import os
import random

import pytest
from pyspark.sql import functions as F, types as T

from topicflow.streaming.jobs import ClosedPanes, DelayedDelivery, TemporalLookup
from topicflow.streaming.slots import LAST, AtomicSinks, CompactedTable, TimerWheel

ROW = T.StructType([T.StructField("key", T.StringType()), T.StructField("ts", T.LongType()), T.StructField("value", T.StringType())])


def _files(root):
    return [os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.startswith("part-")]


def test_a_batch_rewrites_the_buckets_of_its_keys_only(spark, tmp_path):
    table = CompactedTable(spark, str(tmp_path), ROW, "key", ["ts"], ["value"], buckets=8, keep_tombstones=lambda ts, newest: ts >= newest - 10)
    add = lambda rows, b: table.merge(spark.createDataFrame(rows, ROW), b)
    add([(f"k{i}", 1, "a") for i in range(100)] + [(None, 5, "x")], 0)
    before = table.table.manifest()
    assert len(before) == 8 and all(g == [0] for g in before.values())
    assert len(add([("k7", 2, "b"), ("k7", 1, "old")], 1)) == 1
    assert sorted(g for gs in table.table.manifest().values() for g in gs) == [0] * 7 + [1]
    # the batch runs again: same result; then a tombstone, an older row behind it, and its compaction
    add([("k7", 2, "b"), ("k7", 1, "old")], 1)
    add([("k7", 3, None)], 2)
    add([("k7", 2, "late")], 3)
    got = {r.key: (r.ts, r.value) for r in table.rows().collect()}
    assert got == {f"k{i}": (1, "a") for i in range(100) if i != 7}
    bucket = table._bucket()
    same = [r.key for r in table.rows().where(bucket == spark.range(1).select(F.lit("k7").alias("key")).select(bucket).first()[0]).collect()]
    add([(same[0], 50, "c")], 4)
    assert table.table.read(table.table.manifest()).where("value is null").count() == 0
    assert table.rows(of=spark.createDataFrame([(same[0],)], "key string")).count() == len(same)
    assert table.merge(spark.createDataFrame([], ROW), 5) == [] and table.rows().count() == 99
    # what no manifest in use names is deleted
    assert len(_files(f"{tmp_path}/data")) <= 8 + 2 and len(os.listdir(f"{tmp_path}/manifest")) <= 3


def test_timer_wheel_over_100_batches(spark, tmp_path):
    """Every row comes out once, in the batch whose frontier reaches it; the
    slots and files in use stay few although every batch adds rows."""
    r = random.Random(1)
    schema = T.StructType.fromDDL("id long, due long")
    wheel = TimerWheel(spark, str(tmp_path), schema, "due", 60)
    waiting, frontier, most, next_id = {}, 0, 0, 0
    for b in range(100):
        frontier += r.choice([0, 5, 59, 60, 61, 900])
        new = []
        for _ in range(4):
            due = r.choice([frontier - 5, frontier, frontier + r.randint(1, 100), frontier + r.randint(1, 3_000), frontier + r.randint(1, 90_000), (1 << 63) - 1, -(1 << 62)])
            new.append((next_id, due))
            next_id += 1
        waiting.update(new)
        if b % 10 == 3:  # a first try that fails before its commit
            wheel.turn(b, frontier, spark.createDataFrame(new, schema)).collect()
        got = {x.id: x.due for x in wheel.turn(b, frontier, spark.createDataFrame(new, schema)).collect()}
        wheel.commit()
        want = {i: d for i, d in waiting.items() if d <= frontier}
        assert got == want, b
        for i in want:
            del waiting[i]
        most = max(most, len(_files(f"{tmp_path}/data")))
    assert {x.id: x.due for x in wheel.rest().collect()} == waiting and waiting
    assert most <= 3 * TimerWheel.MERGE * (TimerWheel.RATIO + 1)


def test_sinks_become_visible_together(spark, tmp_path):
    sinks = AtomicSinks(spark, str(tmp_path))
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("u",)], "y string")
    assert sinks.read("a", a.schema).count() == 0
    sinks.write(0, {"a": a, "b": b})
    with pytest.raises(Exception):
        sinks.write(1, {"a": a, "b": b.select(F.raise_error(F.lit("between the sinks")).alias("y"))})
    assert (sinks.read("a", a.schema).count(), sinks.read("b", b.schema).count()) == (1, 1)
    sinks.write(1, {"a": a, "b": b})
    assert (sinks.read("a", a.schema).count(), sinks.read("b", b.schema).count()) == (2, 2)


def test_temporal_lookup_of_interleaved_updates(spark, tmp_path):
    """Rows get the value of their own time though updates come before,
    after and between them, and late within the retention."""
    r = random.Random(2)
    versions = [(r.choice("abc"), t * 3, n, r.choice([None, f"v{n}"])) for n, t in enumerate(sorted(r.randint(0, 100) for _ in range(60)))]
    rows = [(i, r.choice("abcd"), r.randint(0, 320)) for i in range(80)]
    comes = {x[0]: min(4, (x[2] + r.choice([0, 30])) // 80) for x in rows}  # rows up to 30 s late
    row = T.StructType.fromDDL("id int, key string, ts timestamp")
    lookup = TemporalLookup(spark, str(tmp_path), row, retention_s=40)
    for b in range(5):
        some = [x for x in rows if comes[x[0]] == b]
        df = spark.createDataFrame([(i, k, t) for i, k, t in some], "id int, key string, t long").selectExpr("id", "key", "timestamp_seconds(t) as ts")
        vs = spark.createDataFrame([v for v in versions if v[1] // 80 == b], "key string, t long, seq long, value string").selectExpr("key", "timestamp_seconds(t) as ts", "seq", "value")
        batch = lookup.side(df, row, True).unionByName(lookup.side(vs, row, False))
        lookup.add(batch, b)
        if b == 2:
            lookup.add(batch, b)  # again
        if b < 4:
            done = {x.id for x in spark.read.parquet(f"{tmp_path}/joined").collect()}
            assert all(any(v[1] // 80 <= b and v[1] > x[2] for v in versions) for x in some if x[0] in done)
    lookup.finish()
    got = {x.id: x.value for x in lookup.result().collect()}
    want = {}
    all_rows = [(x.id, x.key, int(x.ts.timestamp())) for x in lookup.result().select("id", "key", "ts").collect()]
    assert len(all_rows) == 80
    for i, k, t in all_rows:
        known = [v for v in versions if v[0] == k and v[1] <= t]
        want[i] = max(known, key=lambda v: (v[1], v[2]))[3] if known else None
    assert got == want


def test_empty_topics(spark, tmp_path):
    assert ClosedPanes(spark, f"{tmp_path}/p", 720).segments().count() == 0
    closed = ClosedPanes(spark, f"{tmp_path}/q", 720)
    closed.add(spark.createDataFrame([], "item_type string, item_name string, pane long, cnt long, amt double, first_price double"), 0)
    closed.finish()
    assert closed.segments().count() == 0
    assert DelayedDelivery(spark, f"{tmp_path}/d").result().count() == 0
    assert LAST > 1 << 30
