"""Word fixture (FIXTURES.md §3): tokens, windows, flush counts."""

import datetime as dt

from topicflow.operators import words

BASE = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def _df(spark, rows):
    return spark.createDataFrame([(v, BASE + dt.timedelta(milliseconds=ms)) for v, ms in rows],
                                 "value string, timestamp timestamp")


def test_tokenize_positions(spark):
    df = spark.createDataFrame([(1, " a  B")], "doc_id long, value string")
    got = [(r.pos, r.word) for r in words.tokenize(df).orderBy("pos").collect()]
    assert got == [(0, ""), (1, "a"), (2, ""), (3, "b")]


def test_windowed_counts(spark):
    df = _df(spark, [("Hello hello Kafka", 0), ("kafka", 4999), ("kafka", 5000), ("", 6000)])
    t = {(r.window_start % 100000, r.word): r["count"] for r in words.wordcount_windowed(df, 5000).collect()}
    assert t == {(0, "hello"): 2, (0, "kafka"): 2, (5000, "kafka"): 1, (5000, ""): 1}
    h = words.wordcount_windowed(df, 5000, 1000)
    assert h.where("word = 'kafka'").groupBy().sum("count").first()[0] == 5 * 3
    f = words.format_windowed(words.wordcount_windowed(df, 5000)).where("word = 'hello'").first()
    assert f.line == f"key=hello, value=2, start={f.window_start}, end={f.window_end}\n"


def test_flush_counts(spark):
    df = _df(spark, [("a b", 100), ("a", 900), ("a", 1000)])
    got = sorted((r.flush_time % 100000, r.word, r["count"]) for r in words.wordcount_flush(df).collect())
    assert got == [(1000, "a", 2), (1000, "b", 1), (2000, "a", 1)]


def test_total(spark):
    df = spark.createDataFrame([("A a",), ("a ",)], "value string")
    assert {r.word: r["count"] for r in words.wordcount_total(df).collect()} == {"a": 3}


def test_flush_counts_by_partition(spark):
    """Q3: the reference's processor counts per input partition; the option
    keeps that literal form, the default is global per word."""
    rows = [("a", 100, 0), ("a", 200, 1), ("a", 300, 1)]
    df = spark.createDataFrame([(v, BASE + dt.timedelta(milliseconds=ms), p) for v, ms, p in rows],
                               "value string, timestamp timestamp, partition int")
    got = sorted((r.partition, r["count"]) for r in words.wordcount_flush(df, by_partition=True).collect())
    assert got == [(0, 1), (1, 2)]
    assert [r["count"] for r in words.wordcount_flush(df).collect()] == [3]
