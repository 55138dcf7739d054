"""Changelog folding and lookups: tombstones, misses, event-time ties."""

import datetime as dt

from pyspark.sql import functions as F

from topicflow.operators import tables


def _ts(s):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)


def test_table_latest_tombstone(spark):
    chg = spark.createDataFrame([("a", "1", _ts(0), 0), ("a", "2", _ts(5), 1), ("b", "x", _ts(1), 2),
                                 ("b", None, _ts(9), 3), ("c", None, _ts(1), 4), ("c", "y", _ts(2), 5)],
                                "key string, value string, ts timestamp, seq long")
    got = {r.key: r.value for r in tables.table_latest(chg).collect()}
    assert got == {"a": "2", "c": "y"}


def test_asof_lookup(spark):
    day = 86400
    chg = spark.createDataFrame([("u", "v1", _ts(10), 1), ("u", "v2", _ts(20), 2), ("u", None, _ts(30), 3),
                                 ("u", "v3", _ts(2 * day), 4), ("w", "z", _ts(5), 5)],
                                "key string, value string, ts timestamp, seq long")
    st = spark.createDataFrame([(1, "u", _ts(5)), (2, "u", _ts(10)), (3, "u", _ts(25)), (4, "u", _ts(35)),
                                (5, "u", _ts(day + 1)), (6, "u", _ts(2 * day + 1)), (7, "w", _ts(3 * day)),
                                (8, "x", _ts(1)), (9, None, _ts(1))],
                               "id int, key string, ts timestamp")
    got = {r.id: r.value for r in tables.asof_lookup(st, chg).collect()}
    # miss, tie (table first), newest, tombstone, next day (carried
    # tombstone), later value, carried over days, unknown key, null key
    assert got == {1: None, 2: "v1", 3: "v2", 4: None, 5: None, 6: "v3", 7: "z", 8: None}


def test_lookup_concat_null(spark):
    s = spark.createDataFrame([("a", "x"), ("b", "y")], "key string, value string")
    t = spark.createDataFrame([("a", "1")], "key string, value string")
    got = {r.key: r.value for r in tables.lookup_concat(s, t).collect()}
    assert got == {"a": "x***1", "b": "y***null"}


def test_event_time(spark):
    df = spark.createDataFrame([("order", 5), ("item", None), ("user", None), ("x", None)], "e string, td long")
    got = [r.t for r in df.select(tables.extract_event_time(F.col("e"), F.col("td")).alias("t")).collect()]
    assert got == [5, 1449795610000, 1449792010000, 1447113610000]


def test_null_stream_keys_are_skipped(spark):
    s = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    t = spark.createDataFrame([("a", "x")], "name string, w string")
    assert [tuple(r) for r in tables.lookup_join(s, t, "k", "name").collect()] == [("a", 1, "a", "x")]


def test_class_and_time_by_shape(spark):
    rows = ['{"userName":null,"itemName":"i","transactionDate":7,"quantity":1}', '{"itemName":"i","address":null,"type":null,"price":null}',
            '{"name":"n","address":"a","gender":null,"age":3}', '{"transactionDate":9}', '{"transactionDate":"x"}', '{"transactionDate":null}',
            '{"a":1}', '[1]', '"s"', 'null', 'no json', '', None]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, r string").withColumn("v", F.try_parse_json("r"))
    got = [tuple(x) for x in df.select(tables.record_class(F.col("v")), tables.event_time_of_record(F.col("v"))).orderBy("k").collect()]
    other = 1447113610000
    assert got == [("order", 7), ("item", 1449795610000), ("user", 1449792010000), ("json", 9), ("json", other), ("json", other)] + [("other", other)] * 7


def test_asof_of_a_key_over_many_ranges(spark):
    """One key fills all ranges: the newest version is carried over them."""
    versions = spark.createDataFrame([("k", 1, 1, "first"), ("k", 900, 2, "second"), ("z", 0, 3, "z")], "key string, t long, seq long, value string")
    rows = spark.createDataFrame([("k", t, t) for t in range(0, 2000)] + [("a", 5, -1), ("k", None, -2), (None, 5, -3)], "key string, t long, id long")
    at = lambda d: d.withColumn("ts", F.timestamp_seconds("t")).drop("t")
    got = {r.id: r.value for r in tables.asof_lookup(at(rows), at(versions)).collect()}
    assert got == {**{t: None if t < 1 else "first" if t < 900 else "second" for t in range(2000)}, -1: None, -2: None}
