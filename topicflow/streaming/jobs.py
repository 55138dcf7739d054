"""The ``stream_*`` queries: the batch operators run under Structured
Streaming over the driver tables staged as a topic (see :mod:`runner`).
Each returns the final result table, which equals its batch twin."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from topicflow.functions.codec import from_json_strict, header_long
from topicflow.functions.java import split_words
from topicflow.operators import purchases, sweep, tables
from topicflow.operators.partitioning import assign_partition
from topicflow.schemas import (DEFAULT_RETENTION, DELAY_HEADER, DELAY_TOPIC, FLUSH_INTERVAL_MS, ORDER_JSON_FIELDS,
                               TOPIC_PARTITIONS)
from topicflow.session import exists, scratch_path, staged
from topicflow.sources import driver
from topicflow.sources.log import keyed_json_records, read_log_stream, write_log
from topicflow.streaming.runner import END, read_result, run_bounded, updated_table, without_end
from topicflow.streaming.slots import LAST, AtomicSinks, CompactedTable, Frontier, TimerWheel

# the closing record of a finished topic lies this much after its last one
CLOSE_AFTER = dt.timedelta(days=30)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order topic as a stored table: its two tables are joined once, not
    for its bounds and again for every chunk that is staged."""
    return staged(driver.orders(spark, sf_dir), "orders")


def stream_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + J1 (+ S4, ST8, ST9): the order topic read as a stream, each order
    joined to the user table (stream-static left join)."""
    orders = _orders(spark, sf_dir)
    users = driver.users(spark, sf_dir)
    out = run_bounded(spark, "lookup", orders, "transaction_date",
                      lambda s: tables.order_user(s, users))
    return read_result(spark, out)


def stream_table_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + ST6 + K3: the changelog read as a stream and folded, micro-batch
    by micro-batch, into a compacted table: a batch rewrites the buckets of
    its keys only, and no state is kept but the table.  Tombstones go once
    they are a retention older than the newest record."""
    chg = driver.changelog(spark, sf_dir).select("key", "ts", "seq", "value")
    root = scratch_path(spark, "stream-table-latest")
    table = CompactedTable(spark, f"{root}/table", chg.schema, "key", ["ts", "seq"], ["value"],
                           keep_tombstones=lambda ts, newest: ts >= newest - F.expr(f"INTERVAL {DEFAULT_RETENTION}"))
    run_bounded(spark, "table-latest", chg, "ts", lambda s: s, root=root, foreach=table.merge)
    return table.rows()


def stream_wordcount_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + K3: running count per word over the document stream, update
    mode; the table holds each word's latest count."""
    docs = driver.documents(spark, sf_dir)

    def build(s):
        return (s.select(F.explode(split_words(F.col("value"))).alias("word"))
                .groupBy("word").agg(F.count(F.lit(1)).alias("count")))
    out = run_bounded(spark, "wordcount-total", docs, "doc_id", build, mode="update", key="word")
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("count", T.LongType())])
    return updated_table(spark, out, schema, "word").rows().select("word", "count")


def windowed_word_counts(s: DataFrame, size: str = "5 seconds",
                         retention: str = DEFAULT_RETENTION) -> DataFrame:
    """TW1 + ST3 on a stream of ``value, timestamp`` records: tumbling counts
    per word; records older than the watermark (newest time − retention)
    are dropped as late, windows are emitted once the watermark passes."""
    s = s.withWatermark("timestamp", retention)
    if END in s.columns:
        s = without_end(s)
    w = (s.select(F.col("timestamp"), F.explode(split_words(F.col("value"))).alias("word"))
         .groupBy(F.window("timestamp", size).alias("w"), "word")
         .agg(F.count(F.lit(1)).alias("count")))
    return w.select(F.unix_millis(F.col("w.start")).alias("window_start"),
                    F.unix_millis(F.col("w.end")).alias("window_end"), "word", "count")


def stream_wordcount_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TW1 + ST3 + K1: 5 s tumbling word counts on record time with the
    default one-day retention as watermark, append mode to a file sink."""
    out = run_bounded(spark, "wordcount-tumbling", driver.timed_words(spark, sf_dir), "timestamp",
                      windowed_word_counts, close_after=CLOSE_AFTER)
    return read_result(spark, out)


def flush_counts(s: DataFrame, interval_ms: int = FLUSH_INTERVAL_MS, retention: str = DEFAULT_RETENTION) -> DataFrame:
    """ST4: words counted since the last flush, emitted and reset every
    interval of event time.  The counts between two flushes are those of one
    tumbling window, so this is a windowed aggregate: combined map-side, JVM
    state, and records that arrive out of order within the retention count."""
    w = windowed_word_counts(s, f"{interval_ms} milliseconds", retention)
    return w.select(F.col("window_end").alias("flush_time"), "word", "count")


def stream_flush_count(spark: SparkSession, sf_dir: str, order_col: str = "timestamp", retention: str = DEFAULT_RETENTION) -> DataFrame:
    """ST4 + A8 + S3/K2: per-word counts emitted and reset every second of
    event time.  ``order_col`` is the order of arrival."""
    out = run_bounded(spark, "flush-count", driver.timed_words(spark, sf_dir), order_col,
                      lambda s: flush_counts(s, retention=retention),
                      close_after=CLOSE_AFTER if order_col == "timestamp" else None)
    return read_result(spark, out)


class TemporalLookup:
    """J1 on two streams: every row gets the value that its key had at the
    row's own time, however the updates of the table fall between the
    micro-batches.

    Rows wait until the changelog has come past their time.  Versions wait
    for ``retention`` (so that rows may come that much late) and then go into
    a compacted table of the newest version per key; a batch reads the
    versions that wait and the buckets of its due keys.  Where a row is later
    still, only versions newer than it may be left, and it finds none.
    Versions of one time count in the order of ``seq``; on equal time the
    version counts as earlier than the row.  Rows and versions with a null
    key are skipped, as are versions without a time; rows without a time
    find nothing, at once."""

    VERSIONS = "key string, ts timestamp, seq long, value string, due long"

    def __init__(self, spark: SparkSession, root: str, row: T.StructType, retention_s: int = 86_400):
        self.spark, self.root, self.retention = spark, root, retention_s * 1_000_000
        rows = T.StructType([T.StructField("key", T.StringType()), T.StructField("ts", T.TimestampType()),
                             T.StructField("row", row), T.StructField("due", T.LongType())])
        minute = 60_000_000
        self.rows = TimerWheel(spark, f"{root}/rows", rows, "due", minute)
        self.versions = TimerWheel(spark, f"{root}/versions", _schema(self.VERSIONS), "due", minute)
        self.base = CompactedTable(spark, f"{root}/base", _schema(self.VERSIONS), "key", ["due", "seq"], ["value"],
                                   keep_tombstones=lambda due, newest: due >= newest - self.retention)
        self.frontier = Frontier(spark, f"{root}/frontier")     # newest time of the changelog

    @staticmethod
    def side(df: DataFrame, of: T.StructType, row: bool) -> DataFrame:
        """One of the two streams in the form that :meth:`add` takes."""
        cells = F.struct(*[F.col(f.name) for f in of]) if row else F.lit(None).cast(of)
        seq, value = (F.lit(None).cast("long"), F.lit(None).cast("string")) if row else (F.col("seq"), F.col("value"))
        return df.select(F.lit(row).alias("is_row"), "key", "ts", seq.alias("seq"), value.alias("value"), cells.alias("row"))

    def _joined(self, rows: DataFrame, base: DataFrame, versions: DataFrame) -> DataFrame:
        table = base.select("key", "ts", "seq", "value").unionByName(versions.select("key", "ts", "seq", "value"))
        return tables.asof_lookup(rows.select("key", "ts", "row"), table).select("row.*", "value")

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch of both streams."""
        batch = batch.where(F.col("key").isNotNull()).withColumn("due", F.unix_micros("ts")).persist()
        new_rows = batch.where("is_row").withColumn("due", F.coalesce("due", F.lit(-(1 << 62)))).select(*self.rows.table.schema.names)
        new_versions = batch.where("not is_row and due is not null").select(*self.versions.table.schema.names)
        newest, before = new_versions.agg(F.max("due")).first()[0], self.frontier.get(batch_id)
        now = max((x for x in (newest, before) if x is not None), default=-(1 << 62))
        due = self.rows.turn(batch_id, now - 1, new_rows).persist()
        recent = self.versions.rest(batch_id).unionByName(new_versions)
        self._joined(due, self.base.rows(batch_id, of=due), recent).write.mode("overwrite").parquet(f"{self.root}/joined/batch={batch_id}")
        passed = self.versions.turn(batch_id, now - self.retention, new_versions)
        self.base.merge(passed, batch_id)
        if now > -(1 << 62):
            self.frontier.put(batch_id, now)
        self.rows.commit()
        self.versions.commit()
        due.unpersist()
        batch.unpersist()

    def finish(self) -> None:
        """Both topics have ended: the rows that still wait are joined."""
        rest = self.rows.rest()
        self._joined(rest, self.base.rows(of=rest), self.versions.rest()).write.mode("overwrite").parquet(f"{self.root}/joined/batch={LAST}")

    def result(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/joined").drop("batch")


def stream_asof_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + J3: two streams, the events of users and the changelog of their
    profiles; each click, view or purchase gets the profile as of its time."""
    rows, versions = driver.profile_lookup(spark, sf_dir)
    root = scratch_path(spark, "stream-asof")
    lookup = TemporalLookup(spark, f"{root}/lookup", rows.schema)
    lo, hi = rows.agg(F.min("ts"), F.max("ts")).first()
    parts = [F.lit(True)] if lo is None else [F.col("ts") < lo + (hi - lo) / 3, F.col("ts") >= lo + (hi - lo) / 3]
    for part in parts:
        rows.where(part).write.mode("append").parquet(f"{root}/rows")
        versions.where(part).write.mode("append").parquet(f"{root}/versions")
        streams = [lookup.side(spark.readStream.schema(df.schema).parquet(f"{root}/{name}"), rows.schema, name == "rows")
                   for name, df in (("rows", rows), ("versions", versions))]
        (streams[0].unionByName(streams[1]).writeStream.option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).foreachBatch(lookup.add).start().awaitTermination())
    lookup.finish()
    return lookup.result()


class RunningTotals:
    """A9 as a stream: after every purchase the updated totals of its key, as
    append-only rows.  A micro-batch is numbered range by range (no key in
    one task), on top of the totals that a compacted table carries from the
    batches before."""

    TOTALS = "group_key string, order_count long, item_count long, amount double, batch_id int"
    SUMS = ("order_count", "item_count", "amount")
    PURCHASE = ("user_address", "gender", *purchases.ARRIVAL, "item_price")  # the columns of a purchase that count

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.totals = CompactedTable(spark, f"{root}/totals", _schema(self.TOTALS), "group_key", ["batch_id"], self.SUMS)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch of purchases, all later than those before."""
        batch.persist()
        changes = purchases.purchase_changelog(batch)
        keys = batch.select(purchases.region_gender_key().alias("group_key")).distinct()
        carried = self.totals.rows(batch_id, of=keys).select("group_key", *[F.col(c).alias(f"__{c}") for c in self.SUMS])

        def on_top(rows):
            return rows.join(carried, "group_key", "left").withColumns(
                {c: F.col(c) + F.coalesce(f"__{c}", F.lit(0)) for c in self.SUMS}).drop(*[f"__{c}" for c in self.SUMS])

        on_top(changes).write.mode("overwrite").parquet(f"{self.root}/changes/batch={batch_id}")
        quantity = F.col("quantity").cast("long")
        whole = (batch.groupBy(purchases.region_gender_key().alias("group_key"))
                 .agg(F.count(F.lit(1)).alias("order_count"), F.sum(quantity).alias("item_count"),
                      F.sum(F.col("quantity") * F.col("item_price")).alias("amount")))
        self.totals.merge(on_top(whole).withColumn("batch_id", F.lit(batch_id)), batch_id)
        batch.unpersist()

    def changes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/changes").drop("batch")


def stream_purchase_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every intermediate W1 total of the order stream, in arrival order."""
    orders = _orders(spark, sf_dir)
    users, items = driver.users(spark, sf_dir), driver.items(spark, sf_dir)
    root = scratch_path(spark, "stream-changelog")
    totals = RunningTotals(spark, root)
    run_bounded(spark, "changelog", orders, "transaction_date",
                lambda s: purchases.same_region_purchases(s, users, items).select(*RunningTotals.PURCHASE), root=root, foreach=totals.add, n_chunks=3)
    return totals.changes().withColumn("amount", F.round("amount", 2))


TOTALS = "address string, gender string, order_count long, item_count long, amount double"
PURCHASES = "order_key long, line_number int, user_name string, item_name string, quantity int, item_price double"


def _fan_out(spark: SparkSession, sf_dir: str) -> tuple[AtomicSinks, str]:
    """K11 + S5: one purchase stream feeds two sinks — the per-purchase rows
    and the running W1 totals — from one cached micro-batch, which become
    visible together, and a second group reads the topic on its own.  Returns
    the sinks and the folder of the second group."""
    orders = _orders(spark, sf_dir)
    users, items = driver.users(spark, sf_dir), driver.items(spark, sf_dir)
    root = scratch_path(spark, "stream-fanout")
    sinks = AtomicSinks(spark, f"{root}/sinks")

    def fan_out(batch: DataFrame, batch_id: int):
        batch.persist()
        rows = batch.select(*[F.col(f.name).cast(f.dataType) for f in _schema(PURCHASES)])
        sinks.write(batch_id, {"rows": rows, "totals": purchases.purchase_by_region_gender(batch)})
        batch.unpersist()

    inp, ckpt = f"{root}/input", f"{root}/checkpoint"
    lo_hi = orders.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    mid = ((lo_hi[0] or 0) + (lo_hi[1] or 0)) // 2
    first = F.col("transaction_date").isNull() | (F.col("transaction_date") <= mid)
    for part in (first, F.col("transaction_date") > mid):
        orders.where(part).write.mode("append").parquet(inp)
        stream = purchases.same_region_purchases(spark.readStream.schema(orders.schema).parquet(inp), users, items)
        q = (stream.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True).foreachBatch(fan_out).start())
        # A second consumer group — its own checkpoint, so it reads every
        # record again (multicast); inside one query the tasks share the
        # input partitions (unicast)
        q2 = (spark.readStream.schema(orders.schema).parquet(inp).writeStream
              .option("checkpointLocation", f"{root}/checkpoint-group2").trigger(availableNow=True)
              .format("parquet").option("path", f"{root}/group2").start())
        q.awaitTermination()
        q2.awaitTermination()
    return sinks, f"{root}/group2"


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals (region x gender) of the fan-out, over all batches."""
    return _totals(_fan_out(spark, sf_dir)[0].read("totals", _schema(TOTALS)))


def stream_fanout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchase rows of the fan-out."""
    return _fan_out(spark, sf_dir)[0].read("rows", _schema(PURCHASES))


def stream_group2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second group read: every order once."""
    return spark.read.parquet(_fan_out(spark, sf_dir)[1]).select(
        "user_name", "item_name", "transaction_date", "quantity", "order_key", "line_number")


def stream_log_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 + W1 on the log form: orders as JSON records of a stored log,
    read as a stream and decoded strictly, looked up in tables folded from
    keyed changelogs, totalled per micro-batch."""
    def changelog(df, key):  # an older version of every row, then the row
        old = df.select(*[F.lit("old").alias(c) if t == "string" and c != key else F.col(c) for c, t in df.dtypes], F.lit(0).alias("seq"))
        return old.unionByName(df.withColumn("seq", F.lit(1))).withColumn("ts", F.lit(0).cast("timestamp"))

    # folded once, not in every micro-batch
    users, items = (staged(tables.table_latest(changelog(df, key), key=key, value_cols=[c for c in df.columns if c != key]).select(*df.columns), key)
                    for df, key in ((driver.users(spark, sf_dir), "name"), (driver.items(spark, sf_dir), "item_name")))
    orders = driver.orders(spark, sf_dir)
    names = {j: c for c, j in ORDER_JSON_FIELDS.items()}
    schema = T.StructType([T.StructField(j, orders.schema[c].dataType) for j, c in names.items()])
    log = keyed_json_records(orders, "user_name", names, "orders")
    # joined, encoded and placed once: both appends read the stored records
    log = staged(assign_partition(log, TOPIC_PARTITIONS, key_col=F.decode(F.col("key"), "UTF-8")), "orders-log")
    root = scratch_path(spark, "stream-log-totals")

    def totals(batch: DataFrame, batch_id: int):
        purchases.purchase_by_region_gender(batch).write.mode("overwrite").parquet(f"{root}/totals/batch={batch_id}")

    for part in (0, 1):
        write_log(log.where(F.pmod(F.xxhash64("value"), F.lit(2)) == part), f"{root}/log")
        stream = read_log_stream(spark, f"{root}/log").select(from_json_strict(F.decode("value", "UTF-8"), schema).alias("o"))
        # conditions of the lookups stay above this, or they decode every record again (see runner.without_end)
        decoded = (stream.withColumn("__stay", F.rand(0)).where("__stay >= 0")
                   .select(*[F.col(f"o.{j}").alias(c) for j, c in names.items()]))
        (purchases.same_region_purchases(decoded, users, items).writeStream.option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).foreachBatch(totals).start().awaitTermination())
    return _totals(spark.read.parquet(f"{root}/totals"))


def _totals(t: DataFrame) -> DataFrame:
    return (t.groupBy("address", "gender")
            .agg(F.sum("order_count").alias("order_count"), F.sum("item_count").alias("item_count"),
                 F.round(F.sum("amount"), 2).alias("amount")))


class DelayedDelivery:
    """ST5 (streaming): every (record, due header) is delivered once, as soon
    as the newest record time seen reaches its time + delay.

    A micro-batch delivers what of its own rows is due already (however late
    they came) and what has become due of the rows that wait in a timer
    wheel; the rest of its rows goes into the wheel.  No look-back limit, no
    state per key; outputs are written under ``batch=<id>`` and overwritten
    on retry.  A delay beyond the range of times waits for ever."""

    UNIT_MS = 60_000
    OUT = ("topic", "partition", "offset", "key", "value", "timestamp", "header_pos", "delay_seconds")
    WAITING = ("topic string, partition int, offset long, timestamp timestamp, key string, value string, "
               "header_pos int, delay_seconds long, due_ms long")

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.wheel = TimerWheel(spark, f"{root}/waiting", _schema(self.WAITING), "due_ms", self.UNIT_MS)
        self.frontier = Frontier(spark, f"{root}/frontier")

    def deliver(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch of log records."""
        batch.persist()
        before = self.frontier.get(batch_id)
        newest = batch.agg(F.max(F.unix_millis("timestamp"))).first()[0]
        if newest is None:
            batch.unpersist()
            return
        now = max(newest, newest if before is None else before)
        heads = (batch.where(F.col("topic") == DELAY_TOPIC)
                 .select("topic", "partition", "offset", "timestamp", F.decode("key", "UTF-8").alias("key"),
                         F.decode("value", "UTF-8").alias("value"), F.posexplode("headers").alias("header_pos", "h"))
                 .where(F.col("h.key") == DELAY_HEADER).withColumn("delay_seconds", header_long(F.col("h.value")))
                 .where("delay_seconds > 0").drop("h"))
        due = F.coalesce(F.try_add(F.unix_millis("timestamp"), F.try_multiply("delay_seconds", F.lit(1000))), F.lit((1 << 63) - 1))
        out = self.wheel.turn(batch_id, now, heads.withColumn("due_ms", due))
        out.select(*self.OUT).write.mode("overwrite").parquet(f"{self.root}/delivered/batch={batch_id}")
        self.frontier.put(batch_id, now)
        self.wheel.commit()
        batch.unpersist()

    def result(self) -> DataFrame:
        """All deliveries, with those the end of the topic leaves waiting; no
        rows for an empty topic."""
        done = self.spark.createDataFrame([], _schema(self.WAITING)).select(*self.OUT)
        if exists(self.spark, f"{self.root}/delivered"):
            done = self.spark.read.schema(_schema(self.WAITING)).parquet(f"{self.root}/delivered").select(*self.OUT)
        return done.unionByName(self.wheel.rest().select(*self.OUT))


def stream_due_messages(spark: SparkSession, sf_dir: str, order_col: str = "timestamp") -> DataFrame:
    """ST5 (streaming): every due header of topic test delivered once, when
    event time reaches record time + delay.  ``order_col`` is the order of
    arrival."""
    log = driver.log(spark, sf_dir)
    src = log.select("key", "value", "topic", "partition", "offset", "timestamp", "headers")
    root = scratch_path(spark, "stream-due-messages")
    delivery = DelayedDelivery(spark, root)
    run_bounded(spark, "due-messages", src, order_col, lambda s: s, root=root, foreach=delivery.deliver)
    return delivery.result()


def stream_top_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TW3 + ST7: hourly top-10 items per type on a 5 s hop, incrementally.

    Stage 1 adds the stream up to 5 s panes per (type, item) by event time
    (:class:`OpenPanes`): each pane closes once, when the watermark (1 day
    retention) has passed it; the open ones lie in a table, not in the
    memory of the executors.  Exactly the windows that closed in this batch —
    end in (previous frontier, new frontier], where the frontier is the first
    pane that may still be open — are ranked from the table of closed panes by
    the batch algorithm (:class:`ClosedPanes`).  Batch outputs are ranked
    segments of window starts, written under ``batch=<id>`` (idempotent on
    retry) and expanded to windows by the reader.  A closing record, whose
    event time is that of the staged column, pushes the watermark past the
    last pane; windows that end behind it are ranked when the topic ends.  An
    empty topic gives no rows."""
    from topicflow.schemas import TOP_ITEMS_ADVANCE_MS as ADV, TOP_ITEMS_WINDOW_MS as SIZE

    orders = _orders(spark, sf_dir)
    users, items = driver.users(spark, sf_dir), driver.items(spark, sf_dir)
    root = scratch_path(spark, "stream-top-items")
    closed = ClosedPanes(spark, root, SIZE // ADV)
    panes = OpenPanes(closed, lambda s: purchases.adult_purchases(without_end(s), users, items), ADV)
    run_bounded(spark, "top-items", orders.withColumn("ts", F.timestamp_millis("transaction_date")), "ts",
                lambda s: s, root=root, foreach=panes.add, close_after=CLOSE_AFTER, stateful=False)
    closed.finish()
    return purchases.windows_of_segments(closed.segments(), SIZE, ADV, money_digits=2)


class OpenPanes:
    """TW3 + ST3: a stream of records with the event time ``ts``, whose
    purchases (``purchases_of``) are added up to panes of ``advance_ms`` per
    (type, item).

    The purchases of a micro-batch and the totals of the panes still open are
    one aggregate, which tasks may spill, and its result is stored: what is
    open, or comes in one batch, may be larger than the executors' memory.
    Panes that end at or before the watermark — the newest event time of all
    batches less ``retention_ms`` — are closed.  Purchases of panes that an
    earlier batch closed are late and dropped, as are those without a time."""

    def __init__(self, closed: ClosedPanes, purchases_of: Callable[[DataFrame], DataFrame], advance_ms: int,
                 retention_ms: int = 86_400_000):
        self.closed, self.purchases_of, self.advance, self.retention = closed, purchases_of, advance_ms, retention_ms
        self.watermark = Frontier(closed.spark, f"{closed.root}/watermark")

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch of records."""
        newest, before = batch.agg(F.max(F.unix_millis("ts"))).first()[0], self.watermark.get(batch_id)
        times = [t for t in (before, None if newest is None else newest - self.retention) if t is not None]
        if not times:
            return
        late = -(1 << 62) if before is None else before // self.advance     # panes below are closed
        new = (self.purchases_of(batch).withColumn("pane", F.floor(F.unix_millis("ts") / self.advance).cast("long"))
               .where(F.col("pane") >= F.lit(late))
               .select("item_type", "item_name", "pane", F.col("quantity").cast("long").alias("cnt"),
                       (F.col("quantity") * F.col("item_price")).alias("amt"),
                       F.struct(*purchases.ARRIVAL, "item_price").alias("first")))
        totals = (new.unionByName(self.closed.still_open(new.schema, batch_id)).groupBy("item_type", "item_name", "pane")
                  .agg(F.sum("cnt").alias("cnt"), F.sum("amt").alias("amt"), F.min("first").alias("first")))
        frontier = max(times) // self.advance
        totals = totals.withColumns({"first_price": F.col("first.item_price"),
                                     "first": F.when(F.col("pane") >= F.lit(frontier), F.col("first"))})  # of open panes only
        self.closed.add(totals, batch_id, frontier)
        self.watermark.put(batch_id, max(times))


class ClosedPanes:
    """ST7: the table of closed panes of a stream and the ranked segments of
    the windows (``length`` panes long) that they close.

    ``add`` takes the pane totals of a micro-batch; ``finish`` ranks the
    windows that still reach behind the last closed pane.  Totals of panes
    still open lie beside the closed ones and are not ranked; the next batch
    takes them (``still_open``) and gives them back."""

    PANES = "item_type string, item_name string, pane long, cnt long, amt double, first_price double"

    def __init__(self, spark: SparkSession, root: str, length: int):
        self.spark, self.root, self.length = spark, root, length
        self.frontier = Frontier(spark, f"{root}/frontier")     # the first pane that may still be open

    def _panes(self, schema: T.StructType) -> DataFrame:
        stored = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType()), T.StructField("open", T.IntegerType())])
        return self.spark.read.schema(stored).parquet(f"{self.root}/panes")

    def still_open(self, schema: T.StructType, before: int) -> DataFrame:
        """The open panes as the last batch below ``before`` left them."""
        last = self.frontier.last(before)
        if last is None:
            return self.spark.createDataFrame([], schema)
        return self._panes(schema).where((F.col("batch") == last) & (F.col("open") == 1)).select(*schema.names)

    def add(self, batch: DataFrame, batch_id: int, frontier: int | None = None) -> None:
        """Pane totals of a micro-batch, one row per pane and (type, item);
        those from ``frontier`` on are still open (None: all are closed)."""
        is_open = F.lit(0) if frontier is None else (F.col("pane") >= F.lit(frontier)).cast("int")
        # sorted by pane, so the pane-range filter of later batches skips
        # row groups by their min/max statistics
        (batch.withColumn("open", is_open).sortWithinPartitions("open", "pane")
         .write.mode("overwrite").partitionBy("open").parquet(f"{self.root}/panes/batch={batch_id}"))
        if frontier is None:
            newest = self._panes(_schema(self.PANES)).where(F.col("batch") == batch_id).agg(F.max("pane")).first()[0]
            if newest is None:
                return
            frontier = newest + 1
        before = self.frontier.get(batch_id) or 0
        frontier = max(before, frontier)     # all panes below it are closed
        self.frontier.put(batch_id, frontier)
        L = self.length
        self._rank(max(before - L + 1, 0), frontier - L + 1, frontier, batch_id)   # window ends in (before, frontier]

    def finish(self) -> None:
        """The topic has ended: the windows that start before its last pane's end."""
        end = self.frontier.get()
        if end is not None:
            self._rank(max(end - self.length + 1, 0), end, end, LAST)

    def _rank(self, lo: int, hi: int, end: int, batch_id: int) -> None:
        """Segments of the window starts in [lo, hi), from panes below ``end``."""
        if hi <= lo:
            return
        panes = (self._panes(_schema(self.PANES)).where((F.col("open") == 0) & (F.col("pane") >= lo) & (F.col("pane") < end))
                 .drop("batch", "open"))
        top = purchases.ranked_segments(panes)
        (top.withColumns({"seg": F.greatest("seg", F.lit(lo)), "seg_end": F.least("seg_end", F.lit(hi))})
         .where("seg < seg_end").write.mode("overwrite").parquet(f"{self.root}/segments/batch={batch_id}"))

    def segments(self) -> DataFrame:
        path = f"{self.root}/segments"
        schema = T.StructType([f for f in _schema(sweep.SEGMENTS) if f.name != "salt"])
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)


def stream_top_items_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7 checked whole: the digest of :func:`stream_top_items`."""
    return purchases.top_items_digest(stream_top_items(spark, sf_dir))
