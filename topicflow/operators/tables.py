"""Changelog tables and stream-table lookups (S2, J1-J4, P7, ST1).

A table is the latest value per key of a changelog; a null value is a
tombstone that deletes the key.  A stream-table lookup is a left equi-join
of each stream row to the table; the event-time form (:func:`asof_lookup`)
gives each stream row the table value as of its own timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from topicflow.functions.java import java_str
from topicflow.operators.sequence import RANGE, in_ranges
from topicflow.schemas import (ITEM_EVENT_MS, OTHER_EVENT_MS, USER_EVENT_MS)


def table_latest(changelog: DataFrame, key: str = "key", order_cols: Sequence[str] = ("ts", "seq"),
                 value_cols: Sequence[str] = ("value",), keep_tombstones: bool = False) -> DataFrame:
    """Fold a changelog into a table: the last row per key in
    ``order_cols`` order; keys whose last row is a tombstone (all value
    columns null) are deleted.

    One aggregate with ``max_by``: partial aggregation runs before the
    shuffle, so a hot key costs one row per map task, not its row count."""
    order = F.struct(*[F.col(c) for c in order_cols])
    payload = F.struct(*[F.col(c) for c in (*order_cols, *value_cols)])
    latest = (changelog.where(F.col(key).isNotNull())
              .groupBy(key).agg(F.max_by(payload, order).alias("__last"))
              .select(key, *[F.col(f"__last.{c}").alias(c) for c in (*order_cols, *value_cols)]))
    if keep_tombstones:
        return latest
    alive = F.lit(False)
    for c in value_cols:
        alive = alive | F.col(c).isNotNull()
    return latest.where(alive)


def lookup_join(stream: DataFrame, table: DataFrame, stream_key: str, table_key: str,
                broadcast: bool | None = None) -> DataFrame:
    """Left join of each stream row to the table row of its key.  Rows with
    a null stream key are skipped.

    Join strategy: by default none is forced.  The planner broadcasts the
    table only when its estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-plans at run time
    from the *measured* shuffle size, so a table that grows with the data
    falls back to a sort-merge join instead of being shipped to every task.
    ``broadcast=True`` is for tables whose size is bounded by construction."""
    t = F.broadcast(table) if broadcast else table
    return stream.where(stream[stream_key].isNotNull()).join(t, stream[stream_key] == t[table_key], "left")


def order_user(orders: DataFrame, users: DataFrame) -> DataFrame:
    """J1 + P7: ``OrderUser`` = order fields + user address, gender, age.
    A miss leaves the strings null and the age 0 (Java int default)."""
    u = users.select(F.col("name").alias("__u_name"), F.col("address").alias("user_address"),
                     F.col("gender"), F.col("age").alias("__age"))
    j = lookup_join(orders, u, "user_name", "__u_name")
    return j.withColumn("age", F.coalesce(F.col("__age"), F.lit(0))).drop("__u_name", "__age")


def order_user_item(orders: DataFrame, users: DataFrame, items: DataFrame,
                    user_filter: Column | None = None) -> DataFrame:
    """Orders -> users (by user) -> optional filter -> items (by item).

    The reference re-keys by item and writes through a hash-partitioned topic
    between the two lookups; in Spark the second join's exchange is that
    repartition.  ``user_filter`` runs between the joins (P5) and is pushed
    by Catalyst as far down as it can go.  An item miss leaves item strings
    null and the price 0.0."""
    ou = order_user(orders, users)
    if user_filter is not None:
        ou = ou.where(user_filter)
    it = items.select(F.col("item_name").alias("__i_name"), F.col("address").alias("item_address"),
                      F.col("type").alias("item_type"), F.col("price").alias("__price"))
    j = lookup_join(ou, it, "item_name", "__i_name")
    return j.withColumn("item_price", F.coalesce(F.col("__price"), F.lit(0.0))) \
            .drop("__i_name", "__price")


def lookup_concat(stream: DataFrame, table: DataFrame, stream_key: str = "key",
                  table_key: str = "key", stream_value: str = "value",
                  table_value: str = "value") -> DataFrame:
    """Left join with a string joiner: ``s1 + "***" + s2`` (``null`` is
    printed for a miss)."""
    t = table.select(F.col(table_key).alias("__t_key"), F.col(table_value).alias("__t_value"))
    j = lookup_join(stream, t, stream_key, "__t_key")
    return j.select(F.col(stream_key).alias("key"),
                    F.concat(java_str(F.col(stream_value)), F.lit("***"),
                             java_str(F.col("__t_value"))).alias("value"),
                    *[c for c in stream.columns if c not in (stream_key, stream_value)])


def asof_lookup(stream: DataFrame, changelog: DataFrame, key: str = "key", ts: str = "ts",
                seq: str = "seq", value_cols: Sequence[str] = ("value",)) -> DataFrame:
    """Event-time lookup.  Each stream row gets the value of the newest
    changelog row of its key with ``(ts, seq)`` not after its own time; on
    equal time the table row counts as earlier.  A tombstone (all values
    null) hides older values.  The stream's own ``value_cols`` (if any) are
    replaced by the looked-up values, null on a miss or after a tombstone.
    Stream rows with a null key are skipped, as are table rows without a key
    or time; stream rows without a time find nothing.

    One pass: stream and table rows are one union, stored once and dealt to
    ranges of (key, time), so that a hot key spans several of them; a window
    inside each (key, range) finds the newest table row before every stream
    row, and where there is none yet, the last one of the key's earlier
    ranges is carried over.  Only a key that crosses the border of a range
    has such a carry, so there are fewer of them than ranges, and they are
    broadcast."""
    payload = F.struct(F.col(ts).cast("timestamp").alias("ts"), F.col(seq).cast("long").alias("seq"), *[F.col(c).alias(f"v_{c}") for c in value_cols])
    versions = (changelog.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
                .select(F.col(key).alias("__k"), F.col(ts).alias("__ts"), F.lit(0).alias("__side"), F.col(seq).cast("long").alias("__seq"),
                        payload.alias("__row")))
    keep = [c for c in stream.columns if c not in value_cols]
    rows = (stream.where(F.col(key).isNotNull())
            .select(F.col(key).alias("__k"), F.col(ts).alias("__ts"), F.lit(1).alias("__side"), F.lit(None).cast("long").alias("__seq"),
                    F.struct(*[F.col(c) for c in keep]).alias("__srow")))
    order = ["__ts", "__side", "__seq"]
    both = in_ranges(versions.unionByName(rows, allowMissingColumns=True), ["__k", *order])

    last = both.groupBy("__k", RANGE).agg(F.max_by("__row", F.when(F.col("__side") == 0, F.struct("__ts", "__seq"))).alias("__last"))
    before = Window.partitionBy("__k").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (last.withColumn("__prev", F.last("__last", ignorenulls=True).over(before)).where(F.col("__prev").isNotNull())
               .select(F.col("__k").alias("__ck"), F.col(RANGE).alias("__cr"), "__prev"))
    inside = Window.partitionBy("__k", RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = both.withColumn("__hit", F.last("__row", ignorenulls=True).over(inside)).where("__side = 1")
    found = hits.join(F.broadcast(carried), (F.col("__k") == F.col("__ck")) & (F.col(RANGE) == F.col("__cr")), "left")
    newest = F.when(F.col("__ts").isNotNull(), F.coalesce("__hit", "__prev"))
    return found.withColumn("__r", newest).select(*[F.col(f"__srow.{c}").alias(c) for c in keep], *[F.col(f"__r.v_{c}").alias(c) for c in value_cols])


def extract_event_time(entity: Column, transaction_date: Column, json: Column | None = None) -> Column:
    """ST1: event time (epoch ms) of a record: an order's transaction date,
    a JSON order's ``transactionDate``; fixed times for items and users; any
    other record a fixed default."""
    parsed = F.lit(None).cast("long") if json is None else F.get_json_object(json, "$.transactionDate").cast("long")
    return (F.when(entity == F.lit("order"), transaction_date)
            .when(entity == F.lit("json"), parsed)
            .when(entity == F.lit("item"), F.lit(ITEM_EVENT_MS))
            .when(entity == F.lit("user"), F.lit(USER_EVENT_MS))
            .otherwise(F.lit(OTHER_EVENT_MS))).cast("long")


def record_class(value: Column) -> Column:
    """F7 on a topic of several classes: what a parsed JSON value (VARIANT)
    is, by the fields that it has, null or not: ``order``, ``item``, ``user``,
    any other object with a transaction date ``json``, else ``other``."""
    def has(*names):
        found = [F.try_variant_get(value, f"$.{n}", "variant").isNotNull() for n in names]
        return found[0] if len(found) == 1 else found[0] & has(*names[1:])

    return (F.when(has("userName", "itemName", "transactionDate", "quantity"), F.lit("order"))
            .when(has("itemName", "type", "price"), F.lit("item"))
            .when(has("name", "gender", "age"), F.lit("user"))
            .when(has("transactionDate"), F.lit("json")).otherwise(F.lit("other")))


def event_time_of_record(value: Column) -> Column:
    """ST1 on a mixed topic: the event time (epoch ms) of a parsed JSON value
    by its class; a value that is no JSON (null) has the default time, as has
    one whose date is no whole number."""
    date = F.try_variant_get(value, "$.transactionDate", "long")
    entity = record_class(value)
    return F.coalesce(extract_event_time(F.when(entity == "json", F.lit("order")).otherwise(entity), date), F.lit(OTHER_EVENT_MS).cast("long"))
