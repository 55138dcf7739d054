"""Batch = stream: each streaming driver, run incrementally over the small
driver tables, ends with the same table as its batch twin."""

import pytest
from pyspark.sql import functions as F

from topicflow.operators import words
from topicflow.plans import catalog
from topicflow.sources import driver
from topicflow.streaming import jobs

from conftest import SMALL


def _same(a, b):
    cols = sorted(b.columns)
    a, b = a.select(*cols), b.select(*cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("stream,batch", [
    ("stream_lookup", "order_user"),
    ("stream_table_latest", "table_latest"),
    ("stream_wordcount_tumbling", "wordcount_tumbling"),
    ("stream_fanout", "purchase_by_region_gender"),
])
def test_stream_equals_batch(spark, stream, batch):
    _same(catalog.STREAM_QUERIES[stream](spark, SMALL), catalog.QUERIES[batch](spark, SMALL))


def test_flush_counter(spark):
    got = catalog.STREAM_QUERIES["stream_flush_count"](spark, SMALL)
    _same(got, words.wordcount_flush(driver.timed_words(spark, SMALL)))


def test_stream_delayed_delivery(spark):
    got = catalog.STREAM_QUERIES["stream_due_messages"](spark, SMALL)
    log = driver.log(spark, SMALL).where(F.col("topic") == "test")
    exp = (log.select("*", F.posexplode("headers").alias("header_pos", "h"))
           .where(F.col("h.key") == "delaySeconds")
           .withColumn("delay_seconds", F.col("h.value").cast("string").try_cast("long"))
           .where(F.col("delay_seconds") > 0))
    assert got.count() == exp.count()
    assert got.groupBy().sum("delay_seconds").first()[0] == exp.groupBy().sum("delay_seconds").first()[0]


def test_late_record_dropped(spark, tmp_path):
    """ST3: with one day of retention, a record more than a day older than
    the newest one seen in an earlier batch is dropped; one inside the
    retention still counts."""
    import datetime as dt
    from topicflow.streaming.jobs import windowed_word_counts
    t0 = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    inp, ck, out = str(tmp_path / "in"), str(tmp_path / "ck"), str(tmp_path / "out")
    schema = "value string, timestamp timestamp"

    def step(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(inp)
        q = (windowed_word_counts(spark.readStream.schema(schema).parquet(inp)).writeStream
             .option("checkpointLocation", ck).trigger(availableNow=True).format("parquet")
             .option("path", out).start())
        q.awaitTermination()

    step([("a", t0), ("b", t0 + dt.timedelta(days=3))])
    step([("late", t0 + dt.timedelta(hours=1)), ("ok", t0 + dt.timedelta(days=2, hours=12))])
    step([("eos", t0 + dt.timedelta(days=30))])
    words = {r.word for r in spark.read.parquet(out).collect()}
    assert "late" not in words and {"a", "b", "ok"} <= words


def test_stream_top_items_equals_batch(spark):
    """ST7: the incremental top items equal the batch result (compared as an
    exact per-(type, rank) digest plus a full-row checksum)."""
    def digest(df):
        h = F.xxhash64("window_start", "item_type", "item_name", "count", "rank",
                       F.round(F.col("amount") * 100).cast("long"), F.round(F.col("price") * 100).cast("long"))
        return {tuple(r) for r in df.groupBy("item_type", "rank")
                .agg(F.count(F.lit(1)), F.sum("count"), F.sum(F.pmod(h, F.lit(1_000_000_007)))).collect()}
    s = catalog.STREAM_QUERIES["stream_top_items"](spark, SMALL)
    b = catalog.QUERIES["top_items_hopping"](spark, SMALL)
    assert digest(s) == digest(b)


def test_records_out_of_time_order(spark):
    """Chunks by event id, not by time: nothing is lost."""
    from topicflow.streaming import jobs
    _same(catalog.STREAM_QUERIES["stream_due_messages"](spark, SMALL), jobs.stream_due_messages(spark, SMALL, order_col="offset"))
    got = jobs.stream_flush_count(spark, SMALL, order_col="seq", retention="400 days")
    whole = words.wordcount_flush(driver.timed_words(spark, SMALL))
    # without a closing record the windows within the retention stay open
    assert got.join(whole, ["flush_time", "word", "count"], "left_anti").count() == 0


def test_late_record_counts_within_retention(spark, tmp_path):
    import datetime as dt
    from topicflow.streaming.jobs import flush_counts
    t0 = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    inp, ck, out = str(tmp_path / "in"), str(tmp_path / "ck"), str(tmp_path / "out")
    schema = "value string, timestamp timestamp"
    for rows in ([("b", t0 + dt.timedelta(seconds=10))], [("a", t0 + dt.timedelta(seconds=1)), ("c", t0 + dt.timedelta(seconds=20))],
                 [("end", t0 + dt.timedelta(days=30))]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(inp)
        (flush_counts(spark.readStream.schema(schema).parquet(inp)).writeStream.option("checkpointLocation", ck)
         .trigger(availableNow=True).format("parquet").option("path", out).start().awaitTermination())
    assert {(r.word, r["count"]) for r in spark.read.parquet(out).collect()} == {("a", 1), ("b", 1), ("c", 1)}


def test_null_order_column_is_kept(spark):
    from topicflow.streaming.runner import read_result, run_bounded
    df = spark.createDataFrame([(1, None), (2, 5), (3, 6), (4, 90)], "id int, o long")
    assert read_result(spark, run_bounded(spark, "nulls", df, "o", lambda s: s)).count() == 4


def test_delayed_delivery_edges(spark, tmp_path):
    """Null keys stay null; a 40-day delay, a 29-digit header and one beyond
    the range of times lose nothing and fail nothing; late records are
    delivered at once."""
    import datetime as dt
    from topicflow.streaming.jobs import DelayedDelivery
    t0 = dt.datetime(2024, 5, 1)
    schema = ("key binary, value binary, topic string, partition int, offset long, timestamp timestamp, "
              "headers array<struct<key:string,value:binary>>")

    def rec(n, seconds, *delays, key=b"k"):
        return (key, b"v", "test", 0, n, t0 + dt.timedelta(seconds=seconds), [("delaySeconds", d) for d in delays])

    d = DelayedDelivery(spark, str(tmp_path))
    d.deliver(spark.createDataFrame([rec(0, 0, b"0" * 27 + b"60", key=None), rec(1, 100, b"5", b"50")], schema), 0)
    d.deliver(spark.createDataFrame([rec(2, 1, b"9"), rec(3, 160, str(40 * 86400).encode(), b"9223372036854775807", b"x")], schema), 1)
    first = {(r.offset, r.delay_seconds) for r in spark.read.parquet(f"{tmp_path}/delivered/batch=0").collect()}
    second = {(r.offset, r.delay_seconds) for r in spark.read.parquet(f"{tmp_path}/delivered/batch=1").collect()}
    assert first == {(0, 60)} and second == {(1, 5), (1, 50), (2, 9)}
    every = d.result().collect()
    assert len(every) == 6 and {r.key for r in every if r.offset == 0} == {None}
    assert {r.delay_seconds for r in every if r.offset == 3} == {40 * 86400, 2**63 - 1}


def test_orders_are_joined_once_for_a_stream(spark):
    """Bounds and chunks of a staged topic read stored orders, not the join of the driver tables."""
    plan = jobs._orders(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Scan parquet" in plan


def test_top_items_hold_no_state_in_the_executors(spark, tmp_path):
    """The panes that a stream of orders has open lie in a table; in a state store half
    of all panes were in the executors' memory at once."""
    import os
    from topicflow.session import checkpoint_root
    root = checkpoint_root(spark)
    before = set(os.listdir(root.removeprefix("file:")))
    jobs.stream_top_items(spark, SMALL)
    new = [f for f in set(os.listdir(root.removeprefix("file:"))) - before if f.startswith("stream-top-items")]
    assert len(new) == 1 and "state" not in os.listdir(f"{root.removeprefix('file:')}/{new[0]}/checkpoint")


def test_open_panes_over_many_batches(spark, tmp_path):
    """Panes are added up over batches, closed once by the watermark and not changed by
    late rows, by a batch that runs again or by rows without a time."""
    import random
    from topicflow.schemas import TOP_ITEMS_ADVANCE_MS as ADV
    r = random.Random(4)
    retention, t0 = 60_000, 1_700_000_000_000 // ADV * ADV
    closed = jobs.ClosedPanes(spark, str(tmp_path), 720)
    panes = jobs.OpenPanes(closed, lambda s: s, ADV, retention_ms=retention)
    schema = ("transaction_date long, order_key long, line_number int, item_name string, quantity int, "
              "item_price double, item_type string")
    want, watermark, late, crossing = {}, None, 0, set()
    for b in range(6):
        rows = [(t0 + b * 40_000 + r.randint(-150_000, 40_000), b * 1000 + i, 1, f"i{r.randint(0, 2)}", r.randint(1, 5),
                 float(r.randint(1, 9)), r.choice("xy")) for i in range(40)] if b != 3 else []
        df = spark.createDataFrame([*rows, (None, 1, 1, "i0", 1, 1.0, "x")], schema).withColumn("ts", F.timestamp_millis("transaction_date"))
        panes.add(df, b)
        if b in (2, 4):
            panes.add(df, b)  # again
        for row in rows:
            key = (row[6], row[3], row[0] // ADV)
            if watermark is not None and (key[2] + 1) * ADV <= watermark:
                late += 1
                continue
            if any(x[1] // 1000 < b for x in want.setdefault(key, [])):
                crossing.add(key)
            want[key].append(row)
        watermark = max([watermark or 0, *(row[0] - retention for row in rows)])
    panes.add(spark.createDataFrame([(t0 + 10_000_000, 9, 9, "i0", 1, 1.0, "x")], schema).withColumn("ts", F.timestamp_millis("transaction_date")), 6)
    got = {(x.item_type, x.item_name, x.pane): (x.cnt, x.amt, x.first_price)
           for x in spark.read.parquet(f"{tmp_path}/panes").where("open = 0").collect()}
    assert late > 10 and len(crossing) > 3
    assert got == {k: (sum(x[4] for x in v), sum(x[4] * x[5] for x in v), min(v)[5]) for k, v in want.items()}
    closed.finish()
    starts = {s for x in closed.segments().collect() for s in range(x.seg, x.seg_end)}
    assert starts == {s for _, _, pane in got for s in range(pane - 719, pane + 1)}
