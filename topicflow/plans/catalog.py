"""The registered queries.

Each entry reads the driver tables under ``sf_dir`` (whole tables, whole
texts) and returns a DataFrame; ``ORACLE_SQL`` holds the DuckDB SQL that
computes the same rows from the same parquet views.  Money columns are
rounded to cents at the very end, in both, because double sums depend on
the order of additions; the operators themselves never round.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from topicflow.functions.codec import from_json_strict, to_json_all_fields
from topicflow.functions.java import java_hash
from topicflow.operators import delay, offsets, partitioning, purchases, tables, words
from topicflow.plans import sqlviews as V
from topicflow.schemas import DELAY_LOOKBACK_S, ITEM_JSON_FIELDS, ORDER_JSON_FIELDS, TOPIC_PARTITIONS, USER_JSON_FIELDS
from topicflow.session import ensure_conf, scratch_path
from topicflow.sources import driver, lines
from topicflow.sources.index import LogIndex

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return run
    return deco


def _cents(c):
    return F.round(c, 2)


def _inputs(spark, sf_dir):
    return driver.orders(spark, sf_dir), driver.users(spark, sf_dir), driver.items(spark, sf_dir)


# ----------------------------------------------------------------- purchases
@register("purchase_by_region_gender", V.with_(V.ORDERS, V.USERS, V.ITEMS, V.ORDER_USER, V.OUI_W1) + """
SELECT user_address AS address, gender, COUNT(*) AS order_count,
       CAST(SUM(quantity) AS BIGINT) AS item_count, ROUND(SUM(quantity * item_price), 2) AS amount
FROM purchases GROUP BY user_address, gender""")
def q_purchase_by_region_gender(spark, sf_dir):
    """Orders whose user and item share an address, per (address, gender)."""
    p = purchases.same_region_purchases(*_inputs(spark, sf_dir))
    t = purchases.purchase_by_region_gender(p)
    return t.withColumn("amount", _cents("amount"))


@register("purchase_by_gender", V.with_(V.ORDERS, V.USERS, V.ITEMS, V.ORDER_USER, V.OUI_W1) + """
SELECT gender, ROUND(SUM(quantity * item_price), 2) AS amount FROM purchases WHERE gender IS NOT NULL GROUP BY gender""")
def q_purchase_by_gender(spark, sf_dir):
    """Amount per gender over the same-region purchases."""
    p = purchases.same_region_purchases(*_inputs(spark, sf_dir))
    return purchases.purchase_by_gender(p).withColumn("amount", _cents("amount"))


@register("purchase_report", V.with_(V.ORDERS, V.USERS, V.ITEMS, V.ORDER_USER, V.OUI_W1) + """,
t AS (SELECT user_address AS address, gender, COUNT(*) AS order_count,
             CAST(SUM(quantity) AS BIGINT) AS item_count, ROUND(SUM(quantity * item_price), 2) AS amount
      FROM purchases GROUP BY user_address, gender)
SELECT address, gender, address || ',' || COALESCE(gender, 'null') AS group_key, order_count, item_count,
       amount,
       address || ',' || COALESCE(gender, 'null') || '_' || order_count || '_' || item_count || '_' || CAST(amount AS VARCHAR) AS line_underscore,
       address || ',' || COALESCE(gender, 'null') || ',' || order_count || ',' || item_count || ',' || CAST(amount AS VARCHAR) AS line_comma
FROM t""")
def q_purchase_report(spark, sf_dir):
    """W1 rows printed as ``key_oc_ic_amt`` and ``key,oc,ic,amt``
    (amount in cents precision; JVM and DuckDB print doubles alike below 1e7)."""
    p = purchases.same_region_purchases(*_inputs(spark, sf_dir))
    return purchases.purchase_report(purchases.purchase_by_region_gender(p), money_digits=2)


@register("purchase_changelog", V.with_(V.ORDERS, V.USERS, V.ITEMS, V.ORDER_USER, V.OUI_W1) + """
SELECT user_address || ',' || COALESCE(gender, 'null') AS group_key, transaction_date, order_key, line_number,
       item_name, quantity,
       COUNT(*) OVER w AS order_count, CAST(SUM(quantity) OVER w AS BIGINT) AS item_count,
       ROUND(SUM(quantity * item_price) OVER w, 2) AS amount
FROM purchases
WINDOW w AS (PARTITION BY user_address || ',' || COALESCE(gender, 'null')
             ORDER BY transaction_date, order_key, line_number, item_name, quantity ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_purchase_changelog(spark, sf_dir):
    """Every intermediate W1 total, in arrival order."""
    p = purchases.same_region_purchases(*_inputs(spark, sf_dir))
    return purchases.purchase_changelog(p).withColumn("amount", _cents("amount"))


@register("order_user", V.with_(V.ORDERS, V.USERS, V.ORDER_USER) + """
SELECT user_name, item_name, transaction_date, quantity, order_key, line_number, user_address, gender, age
FROM order_user""")
def q_order_user(spark, sf_dir):
    """J1 + P7: every order with its user's fields (miss: nulls and age 0)."""
    o, u, _ = _inputs(spark, sf_dir)
    return tables.order_user(o, u)


@register("order_user_item", V.with_(V.ORDERS, V.USERS, V.ITEMS, V.ORDER_USER) + """
SELECT ou.user_name, ou.item_name, ou.transaction_date, ou.quantity, ou.order_key, ou.line_number,
       ou.user_address, ou.gender, ou.age, i.address AS item_address, i.type AS item_type,
       COALESCE(i.price, 0.0) AS item_price
FROM order_user ou LEFT JOIN items_t i ON ou.item_name = i.item_name""")
def q_order_user_item(spark, sf_dir):
    """The chained lookup orders -> users -> items, no filter."""
    return tables.order_user_item(*_inputs(spark, sf_dir))


@register("filter_adults", V.with_(V.ORDERS, V.USERS, V.ORDER_USER) + """
SELECT user_name, item_name, transaction_date, quantity, order_key, line_number, user_address, gender, age
FROM order_user WHERE user_address IS NOT NULL AND age BETWEEN 18 AND 35""")
def q_filter_adults(spark, sf_dir):
    """P5: known users aged 18..35 inclusive."""
    o, u, _ = _inputs(spark, sf_dir)
    return purchases.filter_adults(o, u)


@register("lookup_concat", V.with_(V.ORDERS, V.USERS) + """
SELECT o.user_name AS key, o.item_name || '***' || COALESCE(u.address, 'null') AS value,
       o.order_key, o.line_number
FROM orders_s o LEFT JOIN users_t u ON o.user_name = u.name""")
def q_lookup_concat(spark, sf_dir):
    """Order stream (user -> item) joined to the user table (user ->
    address) with the string joiner ``item***address``."""
    o, u, _ = _inputs(spark, sf_dir)
    s = o.select(F.col("user_name").alias("key"), F.col("item_name").alias("value"),
                 "order_key", "line_number")
    t = u.select(F.col("name").alias("key"), F.col("address").alias("value"))
    return tables.lookup_concat(s, t)


@register("table_latest", V.with_(V.CHANGELOG) + """,
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, seq DESC) AS rn FROM chg WHERE key IS NOT NULL)
SELECT key, ts, seq, value FROM r WHERE rn = 1 AND value IS NOT NULL""")
def q_table_latest(spark, sf_dir):
    """The events changelog folded to the latest value per user
    (users whose last event is an error are deleted)."""
    return tables.table_latest(driver.changelog(spark, sf_dir))


@register("asof_lookup", V.with_(V.CHANGELOG) + """,
s AS (SELECT event_id, CAST(user_id AS VARCHAR) AS key, ts, event_type FROM events
      WHERE event_type IN ('click', 'view', 'purchase')),
t AS (SELECT * FROM chg WHERE seq IN (SELECT event_id FROM events WHERE event_type IN ('signup', 'error'))),
m AS (SELECT s.event_id, s.key, s.ts, s.event_type, t.value,
             row_number() OVER (PARTITION BY s.event_id ORDER BY t.ts DESC, t.seq DESC) AS rn
      FROM s LEFT JOIN t ON s.key = t.key AND t.ts <= s.ts)
SELECT event_id, key, ts, event_type, value FROM m WHERE rn = 1""")
def q_asof_lookup(spark, sf_dir):
    """Each click/view/purchase event gets the user's profile (props of
    the newest signup) as of the event time; an error event deletes it."""
    s, chg = driver.profile_lookup(spark, sf_dir)
    return tables.asof_lookup(s, chg, key="key", ts="ts", seq="seq", value_cols=("value",))


@register("extract_event_time", V.with_(V.ORDERS, V.USERS, V.ITEMS) + """
SELECT 'order' AS entity, user_name AS key, transaction_date AS event_ms FROM orders_s
UNION ALL SELECT 'json', item_name, transaction_date FROM orders_s
UNION ALL SELECT 'other', CAST(n_nationkey AS VARCHAR), 1447113610000 FROM nation
UNION ALL SELECT 'user', name, 1449792010000 FROM users_t
UNION ALL SELECT 'item', item_name, 1449795610000 FROM items_t""")
def q_extract_event_time(spark, sf_dir):
    """ST1: event time of every order, user and item record, of orders as
    JSON text, and of records of any other kind."""
    o, u, i = _inputs(spark, sf_dir)
    n = driver.table(spark, sf_dir, "nation")
    none, no_json = F.lit(None).cast("long").alias("transaction_date"), F.lit(None).cast("string").alias("json")
    as_json = to_json_all_fields({j: F.col(c) for c, j in ORDER_JSON_FIELDS.items()}).alias("json")
    recs = (o.select(F.lit("order").alias("entity"), F.col("user_name").alias("key"), "transaction_date", no_json)
            .unionByName(o.select(F.lit("json").alias("entity"), F.col("item_name").alias("key"), none, as_json))
            .unionByName(n.select(F.lit("other").alias("entity"), F.col("n_nationkey").cast("string").alias("key"), none, no_json))
            .unionByName(u.select(F.lit("user").alias("entity"), F.col("name").alias("key"), none, no_json))
            .unionByName(i.select(F.lit("item").alias("entity"), F.col("item_name").alias("key"), none, no_json)))
    return recs.select("entity", "key", tables.extract_event_time(
        F.col("entity"), F.col("transaction_date"), F.col("json")).alias("event_ms"))


@register("mixed_topic_event_time", V.with_(V.ORDERS, V.USERS, V.ITEMS) + """
SELECT 'order' AS entity, user_name AS key, transaction_date AS event_ms FROM orders_s
UNION ALL SELECT 'json', CAST(o_orderkey AS VARCHAR), epoch_ms(CAST(o_orderdate AS TIMESTAMP)) FROM orders
UNION ALL SELECT 'other', CAST(n_nationkey AS VARCHAR), 1447113610000 FROM nation
UNION ALL SELECT 'user', name, 1449792010000 FROM users_t
UNION ALL SELECT 'item', item_name, 1449795610000 FROM items_t""")
def q_mixed_topic_event_time(spark, sf_dir):
    """ST1 + F7: one stored topic with orders, items, users, bare JSON and
    text; the class and the event time of each by the shape of its value."""
    log = driver.mixed_log(spark, sf_dir).withColumn("v", F.try_parse_json(F.decode("value", "UTF-8")))
    return log.select(tables.record_class(F.col("v")).alias("entity"), F.decode("key", "UTF-8").alias("key"),
                      tables.event_time_of_record(F.col("v")).alias("event_ms"))


# ------------------------------------------------------------- top items
_TOP_SQL = V.with_(V.ORDERS, V.USERS, V.ITEMS, V.ORDER_USER, V.OUI_ADULT) + """,
panes AS (
  SELECT item_type, item_name, CAST(floor(transaction_date / 5000) AS BIGINT) AS pane,
         SUM(quantity) AS cnt, SUM(quantity * item_price) AS amt,
         arg_min(item_price, {'t': transaction_date, 'o': order_key, 'l': line_number, 'i': item_name, 'q': quantity}) AS first_price
  FROM adult GROUP BY item_type, item_name, CAST(floor(transaction_date / 5000) AS BIGINT)),
ex AS (SELECT *, unnest(range(greatest(pane - 719, 0), pane + 1)) AS start FROM panes),
agg AS (SELECT item_type, item_name, start, SUM(cnt) AS cnt, SUM(amt) AS amount,
               arg_min(first_price, pane) AS price
        FROM ex GROUP BY item_type, item_name, start),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_type, start ORDER BY amount DESC, item_name) AS rank
           FROM agg)
"""


# The full W3 result has ~720 rows per purchase (21.8 M rows at sf0.01), too
# many to hash through a driver-side comparison: the full queries carry no
# oracle SQL, and ``top_items_digest`` checks every row of the same result
# through an exact per-(type, rank) digest.  tests/test_purchases.py compares
# the full rows with DuckDB on the small tables and brute force on the fixture.
TOP_ITEMS_FULL_SQL = _TOP_SQL + """
SELECT start * 5000 AS window_start, start * 5000 + 3600000 AS window_end, item_type, item_name,
       CAST(cnt AS BIGINT) AS count, price, ROUND(amount, 2) AS amount, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE rank <= 10"""


TOP_ITEMS_DIGEST_SQL = """
SELECT item_type, rank, COUNT(*) AS windows, CAST(SUM(count) AS BIGINT) AS items,
       CAST(SUM(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS amount_cents,
       CAST(SUM(CAST(round(price * 100) AS BIGINT)) AS BIGINT) AS price_cents,
       MIN(window_start) AS first_start, MAX(window_start) AS last_start,
       CAST(SUM(hash_part) AS BIGINT) AS item_checksum
FROM (SELECT *, CAST(item_name AS BIGINT) % 1000003 * (window_start // 5000 % 1000) AS hash_part
      FROM (""" + TOP_ITEMS_FULL_SQL + """))
GROUP BY item_type, rank"""


@register("top_items_digest", TOP_ITEMS_DIGEST_SQL)
def q_top_items_digest(spark, sf_dir):
    """W3 checked whole: per (type, rank) the number of windows, quantity,
    amount and price totals (exact cents), first/last window and an
    item/window checksum over every row of ``top_items_hopping``."""
    return purchases.top_items_digest(q_top_items_hopping(spark, sf_dir))


@register("top_items_hopping")
def q_top_items_hopping(spark, sf_dir):
    """Users 18..35, 1 h windows every 5 s, top 10 items per type."""
    p = purchases.adult_purchases(*_inputs(spark, sf_dir))
    return purchases.top_items_hopping(p, money_digits=2)


TOP_ITEMS_REPORT_SQL = _TOP_SQL + """,
top AS (SELECT * FROM ranked WHERE rank <= 10)
SELECT start * 5000 AS window_start, start * 5000 + 3600000 AS window_end, item_type,
       CAST(COUNT(*) AS INTEGER) AS n_items,
       string_agg(CAST(start * 5000 AS VARCHAR) || ',' || CAST(start * 5000 + 3600000 AS VARCHAR) || ',' ||
                  item_type || ',' || item_name || ',' || CAST(cnt AS VARCHAR) || ',' || CAST(price AS VARCHAR) || ',' ||
                  CAST(ROUND(amount, 2) AS VARCHAR) || ',' || CAST(rank AS VARCHAR), chr(10) ORDER BY rank)
       || CASE WHEN COUNT(*) < 10 THEN chr(10) ELSE '' END AS report
FROM top GROUP BY start, item_type"""


@register("top_items_report_digest", """
SELECT item_type, COUNT(*) AS reports, CAST(SUM(n_items) AS BIGINT) AS items, CAST(SUM(length(report)) AS BIGINT) AS chars,
       CAST(SUM(CAST('0x' || substr(md5(report), 1, 8) AS BIGINT)) AS BIGINT) AS text_checksum
FROM (""" + TOP_ITEMS_REPORT_SQL + """) GROUP BY item_type""")
def q_top_items_report_digest(spark, sf_dir):
    """T3 checked whole: per type the number of reports and items, their
    characters and a checksum of every report's exact text."""
    text = F.conv(F.substring(F.md5(F.col("report").cast("binary")), 1, 8), 16, 10).cast("long")
    return (q_top_items_report(spark, sf_dir).groupBy("item_type")
            .agg(F.count(F.lit(1)).alias("reports"), F.sum("n_items").cast("long").alias("items"),
                 F.sum(F.length("report")).cast("long").alias("chars"), F.sum(text).cast("long").alias("text_checksum")))


@register("top_items_report")
def q_top_items_report(spark, sf_dir):
    """The printed top-10 block per (window, type)."""
    p = purchases.adult_purchases(*_inputs(spark, sf_dir))
    return purchases.top_items_report(p, money_digits=2)


# --------------------------------------------------------------------- words
@register("tokenize", """
SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, word FROM (
  SELECT doc_id, unnest(toks) AS word, unnest(range(1, len(toks) + 1)) AS pos
  FROM (SELECT doc_id, """ + V.split_words("text") + """ AS toks FROM documents))""")
def q_tokenize(spark, sf_dir):
    """Every token of every whole document."""
    return words.tokenize(driver.documents(spark, sf_dir))


@register("wordcount_total", """
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest(""" + V.split_words("text") + """) AS word FROM documents) GROUP BY word""")
def q_wordcount_total(spark, sf_dir):
    """Running word totals over all documents (final table)."""
    return words.wordcount_total(driver.documents(spark, sf_dir))


def _win_sql(size_ms: int, hop_ms: int) -> str:
    n = size_ms // hop_ms
    return V.with_(V.TIMED_WORDS) + f""",
w AS (SELECT unnest({V.split_words('value')}) AS word, (epoch_us(timestamp) // 1000) AS t FROM tw),
x AS (SELECT word, unnest(range(CAST(floor(t / {hop_ms}) AS BIGINT) - {n - 1},
                               CAST(floor(t / {hop_ms}) AS BIGINT) + 1)) AS k FROM w)
SELECT k * {hop_ms} AS window_start, k * {hop_ms} + {size_ms} AS window_end, word, COUNT(*) AS count
FROM x WHERE k >= 0 GROUP BY k, word"""


@register("wordcount_tumbling", _win_sql(5000, 5000))
def q_wordcount_tumbling(spark, sf_dir):
    """A5/TW1: 5 s tumbling count per word of the timed event words."""
    return words.wordcount_windowed(driver.timed_words(spark, sf_dir), 5000)


@register("wordcount_hopping", _win_sql(5000, 1000))
def q_wordcount_hopping(spark, sf_dir):
    """TW2: 5 s windows advancing by 1 s."""
    return words.wordcount_windowed(driver.timed_words(spark, sf_dir), 5000, 1000)


@register("wordcount_tumbling_fmt", "SELECT *, printf('key=%s, value=%d, start=%d, end=%d', word, count, "
          "window_start, window_end) || chr(10) AS line FROM (" + _win_sql(5000, 5000) + ")")
def q_wordcount_tumbling_fmt(spark, sf_dir):
    """The printed form of the tumbling counts."""
    return words.format_windowed(words.wordcount_windowed(driver.timed_words(spark, sf_dir), 5000))


@register("wordcount_flush", "SELECT window_end AS flush_time, word, count FROM (" + _win_sql(1000, 1000) + ")")
def q_wordcount_flush(spark, sf_dir):
    """What each 1 s flush emits (counts since the previous flush)."""
    return words.wordcount_flush(driver.timed_words(spark, sf_dir))


# ---------------------------------------------------------- hash / placement
@register("java_hash", f"""
SELECT 'customer' AS src, c_name AS s, CAST({V.java_hash('c_name')} AS INTEGER) AS hash FROM customer
UNION ALL SELECT 'part', p_name, CAST({V.java_hash('p_name')} AS INTEGER) FROM part""")
def q_java_hash(spark, sf_dir):
    """F8: String.hashCode of every customer and part name."""
    c = driver.table(spark, sf_dir, "customer").select(F.lit("customer").alias("src"), F.col("c_name").alias("s"))
    p = driver.table(spark, sf_dir, "part").select(F.lit("part").alias("src"), F.col("p_name").alias("s"))
    u = c.unionByName(p)
    return u.select("src", "s", java_hash(F.col("s")).alias("hash"))


@register("partition_hash_mask", V.with_(V.ORDERS) + f"""
SELECT user_name, order_key, line_number,
       CAST(({V.java_hash_u32('user_name')} % 2147483648) % 3 AS INTEGER) AS partition,
       CAST(({V.java_hash_u32('item_name')} % 2147483648) % 3 AS INTEGER) AS item_partition
FROM orders_s""")
def q_partition_hash_mask(spark, sf_dir):
    """M1: placement of every order by user key (producer) and by item key
    (the through-topic of the purchase flow), 3 partitions."""
    o = driver.orders(spark, sf_dir)
    r = partitioning.assign_partition(o, TOPIC_PARTITIONS, "user_name")
    r = partitioning.assign_partition(r, TOPIC_PARTITIONS, "item_name", out="item_partition")
    return r.select("user_name", "order_key", "line_number", "partition", "item_partition")


@register("partition_hash_abs", V.with_(V.ORDERS) + f"""
SELECT user_name, order_key, line_number,
       CAST(abs({V.java_hash('item_name')} % 3) AS INTEGER) AS partition
FROM orders_s""")
def q_partition_hash_abs(spark, sf_dir):
    """M2: 0.8 hash partitioner ``abs(hash % n)`` over item keys."""
    o = driver.orders(spark, sf_dir)
    return partitioning.assign_partition(o, TOPIC_PARTITIONS, "item_name", rule="abs") \
        .select("user_name", "order_key", "line_number", "partition")


@register("partition_random")
def q_partition_random(spark, sf_dir):
    """M3: random placement of every order (rows-only check)."""
    o = driver.orders(spark, sf_dir)
    return partitioning.random_partition(o, TOPIC_PARTITIONS, seed=7) \
        .select("user_name", "order_key", "line_number", "partition")


@register("partition_random_invariant", V.with_(V.ORDERS) + """
SELECT COUNT(*) AS records, 0 AS out_of_range, 3 AS partitions_used FROM orders_s""")
def q_partition_random_invariant(spark, sf_dir):
    """M3: every order is placed, in range, and all partitions are used."""
    p = F.col("partition")
    return q_partition_random(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.when((p >= 0) & (p < TOPIC_PARTITIONS), 0).otherwise(1)).cast("int").alias("out_of_range"),
        F.count_distinct(p).cast("int").alias("partitions_used"))


@register("partition_round_robin", V.with_(V.LOG) + """
SELECT topic, event_id, CAST((row_number() OVER (ORDER BY timestamp, event_id)) % 3 AS INTEGER) AS rr_partition
FROM log_t""")
def q_partition_round_robin(spark, sf_dir):
    """M4: round-robin placement of the events in send (time) order."""
    rows = driver.events_log_rows(spark, sf_dir)
    r = partitioning.round_robin_partition(rows, [F.col("timestamp"), F.col("event_id")], out="rr_partition")
    return r.select("topic", "event_id", "rr_partition")


@register("assign_offsets", V.with_(V.LOG) + """
SELECT topic, partition, "offset", event_id FROM log_t""")
def q_assign_offsets(spark, sf_dir):
    """M5: consecutive offsets per topic partition."""
    return driver.placed_log(spark, sf_dir).select("topic", "partition", "offset", "event_id")


# ------------------------------------------------------------- codec
_ENC_SQL = V.with_(V.ORDERS) + f"""
SELECT user_name AS key,
       to_json(struct_pack(userName := user_name, itemName := item_name,
                           transactionDate := transaction_date, quantity := quantity)) AS value,
       CAST(({V.java_hash_u32('user_name')} % 2147483648) % 3 AS INTEGER) AS partition,
       order_key, line_number
FROM orders_s"""


def _encoded(spark, sf_dir):
    o = driver.orders(spark, sf_dir)
    v = to_json_all_fields({j: F.col(c) for c, j in ORDER_JSON_FIELDS.items()})
    e = o.select(F.col("user_name").alias("key"), v.alias("value"), "order_key", "line_number")
    return partitioning.assign_partition(e, TOPIC_PARTITIONS, "key")


@register("encode_orders", "SELECT key, value, partition, order_key, line_number FROM (" + _ENC_SQL + ")")
def q_encode_orders(spark, sf_dir):
    """K6 + F7: orders as keyed JSON records with their partition."""
    return _encoded(spark, sf_dir).select("key", "value", "partition", "order_key", "line_number")


@register("decode_orders", V.with_(V.ORDERS) + """
SELECT user_name, item_name, transaction_date, quantity, order_key, line_number FROM orders_s""")
def q_decode_orders(spark, sf_dir):
    """F7 decode: strict JSON -> Order round trip of every encoded order."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("userName", T.StringType()), T.StructField("itemName", T.StringType()),
                           T.StructField("transactionDate", T.LongType()), T.StructField("quantity", T.IntegerType())])
    e = _encoded(spark, sf_dir)
    d = e.select(from_json_strict(F.col("value"), schema).alias("o"), "order_key", "line_number")
    return d.select(F.col("o.userName").alias("user_name"), F.col("o.itemName").alias("item_name"),
                    F.col("o.transactionDate").alias("transaction_date"), F.col("o.quantity").alias("quantity"),
                    "order_key", "line_number")


def _record_round_trip(df, fields: dict, key: str, topic: str):
    """K6: rows as keyed JSON records, decoded again."""
    from topicflow.sources.log import keyed_json_records
    names = {j: c for c, j in fields.items()}
    schema = T.StructType([T.StructField(j, df.schema[c].dataType) for j, c in names.items()])
    r = keyed_json_records(df, key, names, topic)
    d = r.select("topic", F.decode("key", "UTF-8").alias("key"), from_json_strict(F.decode("value", "UTF-8"), schema).alias("o"))
    return d.select("topic", "key", *[F.col(f"o.{j}").alias(c) for j, c in names.items()])


@register("user_records", V.with_(V.USERS) + """
SELECT 'users' AS topic, name AS key, name, address, gender, age FROM users_t""")
def q_user_records(spark, sf_dir):
    """K6 + F7: users as keyed JSON records and back."""
    return _record_round_trip(driver.users(spark, sf_dir), USER_JSON_FIELDS, "name", "users")


@register("item_records", V.with_(V.ITEMS) + """
SELECT 'items' AS topic, item_name AS key, item_name, address, type, price FROM items_t""")
def q_item_records(spark, sf_dir):
    """K6 + F7: items as keyed JSON records and back."""
    return _record_round_trip(driver.items(spark, sf_dir), ITEM_JSON_FIELDS, "item_name", "items")


# ---------------------------------------------------------------- log reads
def _log(spark, sf_dir):
    return driver.log(spark, sf_dir)


def _log_cols(df):
    return df.select("topic", "partition", "offset", F.decode("key", "UTF-8").alias("key"),
                     F.decode("value", "UTF-8").alias("value"), "timestamp")


@register("delivery_report", V.with_(V.LOG) + """
SELECT topic, partition, "offset", CAST(octet_length(encode(key_s)) AS INTEGER) AS key_size,
       CAST(octet_length(encode(value_s)) AS INTEGER) AS value_size FROM log_t""")
def q_delivery_report(spark, sf_dir):
    """K8: partition, offset and key/value sizes of every produced record."""
    return offsets.delivery_report(_log(spark, sf_dir))


@register("committed_offsets", V.with_(V.LOG) + """
SELECT topic, partition, MAX("offset") + 1 AS next_offset FROM log_t GROUP BY topic, partition""")
def q_committed_offsets(spark, sf_dir):
    """K9: offsets committed after consuming the whole log."""
    return offsets.committed_offsets(_log(spark, sf_dir))


@register("topic_summary", V.with_(V.LOG) + """
SELECT topic, partition, MIN("offset") AS first_offset, MAX("offset") + 1 AS end_offset, COUNT(*) AS records
FROM log_t GROUP BY topic, partition""")
def q_topic_summary(spark, sf_dir):
    """L3: topic/partition listing with offset range and size."""
    return _index(spark, sf_dir).topic_summary()


def _index(spark, sf_dir):
    return LogIndex(spark, driver.log_path(spark, sf_dir))


@register("offsets_for_times", V.with_(V.LOG) + """
SELECT topic, partition, MIN(CASE WHEN timestamp >= (SELECT MAX(timestamp) FROM log_t) - INTERVAL 1 DAY
                                   THEN "offset" END) AS "offset"
FROM log_t GROUP BY topic, partition""")
def q_offsets_for_times(spark, sf_dir):
    """L2: first offset at/after (newest record time - 1 day), per partition."""
    index = _index(spark, sf_dir)
    return index.offsets_for_times(index.newest() - dt.timedelta(days=1))


@register("offsets_before", V.with_(V.LOG) + """
SELECT topic, partition, COALESCE(MAX(CASE WHEN timestamp < (SELECT MAX(timestamp) FROM log_t) - INTERVAL 3 DAY
                                            THEN "offset" END) + 1, MIN("offset")) AS "offset"
FROM log_t GROUP BY topic, partition""")
def q_offsets_before(spark, sf_dir):
    """L1: offset just after the last record older than (newest - 3 days)."""
    index = _index(spark, sf_dir)
    return index.offsets_before(index.newest() - dt.timedelta(days=3))


@register("replay_since", V.with_(V.LOG) + """,
st AS (SELECT topic, partition, MIN("offset") AS s FROM log_t
       WHERE timestamp >= (SELECT MAX(timestamp) FROM log_t) - INTERVAL 1 DAY GROUP BY topic, partition)
SELECT l.topic, l.partition, l."offset", l.key_s AS key, l.value_s AS value, l.timestamp
FROM log_t l JOIN st ON l.topic = st.topic AND l.partition = st.partition WHERE l."offset" >= st.s""")
def q_replay_since(spark, sf_dir):
    """Rewind every partition to (newest - 1 day) and read to the end."""
    index = _index(spark, sf_dir)
    return _log_cols(index.replay_since(index.newest() - dt.timedelta(days=1)))


@register("pause_partitions", V.with_(V.LOG) + """
SELECT topic, partition, "offset", key_s AS key, value_s AS value, timestamp FROM log_t
WHERE partition NOT IN (0, 1) OR "offset" < 500""")
def q_pause_partitions(spark, sf_dir):
    """A first poll of at most 500 records a partition, then partitions
    0 and 1 are paused."""
    return _log_cols(offsets.pause_partitions(_log(spark, sf_dir), first_poll=500))


@register("bounded_fetch", V.with_(V.LOG) + """,
p AS (SELECT *, SUM(octet_length(encode(key_s)) + octet_length(encode(value_s)))
                  OVER (ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fetched_bytes
      FROM log_t WHERE topic = 'test' AND partition = 0 AND "offset" >= 0)
SELECT topic, partition, "offset", key_s AS key, value_s AS value, timestamp, CAST(fetched_bytes AS BIGINT) AS fetched_bytes
FROM p WHERE fetched_bytes <= 10000""")
def q_bounded_fetch(spark, sf_dir):
    """One 10,000-byte fetch of topic test, partition 0, from offset 0."""
    f = _index(spark, sf_dir).bounded_fetch("test", 0, 0, 10_000)
    return f.select("topic", "partition", "offset", F.decode("key", "UTF-8").alias("key"),
                    F.decode("value", "UTF-8").alias("value"), "timestamp", "fetched_bytes")


# ------------------------------------------------------------- delay
@register("delay_encode", """
SELECT CAST(user_id AS VARCHAR) AS key, strftime(ts, '%Y-%m-%d %H:%M:%S:%g') AS value,
       'delaySeconds' AS header_key, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS header_value
FROM events""")
def q_delay_encode(spark, sf_dir):
    """K7 + F10: every event produced with its send time as payload and a
    ``delaySeconds`` header of ``floor(value)``."""
    e = driver.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.floor("value").cast("long").alias("d"))
    r = delay.delay_encode(e, "d")
    return r.select("key", F.decode("value", "UTF-8").alias("value"),
                    F.col("headers")[0]["key"].alias("header_key"),
                    F.decode(F.col("headers")[0]["value"], "UTF-8").alias("header_value"))


def _due_sql(lookback_ms: int) -> str:
    return V.with_(V.LOG) + """,
now_t AS (SELECT MAX(epoch_us(timestamp) // 1000) + 120000 AS now FROM log_t WHERE topic = 'test'),
st AS (SELECT topic, partition, MIN("offset") AS s FROM log_t, now_t
       WHERE topic = 'test' AND (epoch_us(timestamp) // 1000) >= now - """ + str(lookback_ms) + """ GROUP BY topic, partition),
r AS (SELECT l.* FROM log_t l JOIN st ON l.topic = st.topic AND l.partition = st.partition WHERE l."offset" >= st.s),
h AS (SELECT r.*, 0 AS header_pos, CAST(floor(ev_value / 4) AS BIGINT) AS delay_seconds FROM r WHERE event_type IN ('click', 'view')
      UNION ALL SELECT r.*, 1, CAST(floor(ev_value / 8) AS BIGINT) FROM r WHERE event_type = 'view')
SELECT topic, partition, "offset", key_s AS key, value_s AS value, timestamp, CAST(header_pos AS INTEGER) AS header_pos,
       delay_seconds
FROM h, now_t WHERE delay_seconds > 0 AND now - (epoch_us(timestamp) // 1000) >= delay_seconds * 1000"""


def _due(spark, sf_dir, lookback_s):
    index = _index(spark, sf_dir)
    newest = index.newest("test")
    now = (0 if newest is None else round(newest.timestamp() * 1000)) + 120_000
    d = delay.due_of(index.replay_since(now - lookback_s * 1000, "test"), now)
    return d.select("topic", "partition", "offset", F.decode("key", "UTF-8").alias("key"),
                    F.decode("value", "UTF-8").alias("value"), "timestamp",
                    F.col("header_pos").cast("int").alias("header_pos"), "delay_seconds")


@register("due_messages", _due_sql(180_000))
def q_due_messages(spark, sf_dir):
    """ST5 (one pass): with ``now`` = 2 minutes after the newest record of
    topic test, the records due for delivery from the last 180 s (one per
    due header)."""
    return _due(spark, sf_dir, DELAY_LOOKBACK_S)


@register("due_messages_ten_days", _due_sql(864_000_000))
def q_due_messages_ten_days(spark, sf_dir):
    """ST5 after a long pause: the same pass with a look-back of ten days, so
    records with one, two and bad headers are due."""
    return _due(spark, sf_dir, 864_000)


# ------------------------------------------------------------ ingest
def _order_lines(spark, sf_dir):
    """Text lines rendered from the order tables: one line per line item,
    plus per order a blank line and a 3-field header line (both dropped)."""
    o = driver.orders(spark, sf_dir)
    od = driver.table(spark, sf_dir, "orders")
    body = o.select(F.concat_ws(", ", "user_name", "item_name",
                                F.date_format(F.timestamp_millis("transaction_date"), "yyyy-MM-dd HH:mm:ss"),
                                F.col("quantity").cast("string")).alias("value"))
    noise = od.select(F.explode(F.array(
        F.lit(""), F.concat_ws(", ", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority"),
    )).alias("value"))
    return body.unionByName(noise)


def _text_lines(spark, df):
    """The lines written as text files and read back."""
    path = scratch_path(spark, "lines")
    df.write.text(path)
    return lines.read_lines(spark, path)


@register("ingest_orders", V.with_(V.ORDERS) + """
SELECT user_name, item_name, transaction_date, quantity FROM orders_s""")
def q_ingest_orders(spark, sf_dir):
    """Parse and validate the rendered order lines."""
    return lines.parse_orders(_text_lines(spark, _order_lines(spark, sf_dir)))


@register("ingest_users", V.with_(V.USERS) + """
SELECT name, address, COALESCE(gender, '') AS gender, age FROM users_t""")
def q_ingest_users(spark, sf_dir):
    """User lines (``name, address, gender, age``; a missing gender
    is an empty field, kept as an empty string)."""
    u = driver.users(spark, sf_dir)
    ls = u.select(F.concat_ws(" , ", "name", "address", F.coalesce("gender", F.lit("")),
                              F.col("age").cast("string")).alias("value"))
    return lines.parse_users(_text_lines(spark, ls))


@register("ingest_items", V.with_(V.ITEMS) + """
SELECT item_name, address, type, price FROM items_t""")
def q_ingest_items(spark, sf_dir):
    """Item lines with a price (blank-tolerant double)."""
    i = driver.items(spark, sf_dir)
    ls = i.select(F.concat(F.concat_ws(",", "item_name", "address", "type"), F.lit(", "),
                           F.col("price").cast("string"), F.lit(" ")).alias("value"))
    return lines.parse_items(_text_lines(spark, ls))


# ----------------------------------------------------------------- streaming
def _register_streams():
    from topicflow.streaming import jobs

    def reg(name, fn, sql):
        def run(spark, sf_dir):
            ensure_conf(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        STREAM_QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql

    reg("stream_lookup", jobs.stream_lookup, ORACLE_SQL["order_user"])
    reg("stream_table_latest", jobs.stream_table_latest, ORACLE_SQL["table_latest"])
    reg("stream_wordcount_total", jobs.stream_wordcount_total, ORACLE_SQL["wordcount_total"])
    reg("stream_wordcount_tumbling", jobs.stream_wordcount_tumbling, ORACLE_SQL["wordcount_tumbling"])
    reg("stream_flush_count", jobs.stream_flush_count, ORACLE_SQL["wordcount_flush"])
    reg("stream_fanout", jobs.stream_fanout, ORACLE_SQL["purchase_by_region_gender"])
    reg("stream_group2", jobs.stream_group2, ORACLE_SQL["decode_orders"])
    reg("stream_fanout_rows", jobs.stream_fanout_rows, V.with_(V.ORDERS, V.USERS, V.ITEMS, V.ORDER_USER, V.OUI_W1) + """
SELECT order_key, line_number, user_name, item_name, quantity, item_price FROM purchases""")
    reg("stream_log_totals", jobs.stream_log_totals, ORACLE_SQL["purchase_by_region_gender"])
    reg("stream_asof_lookup", jobs.stream_asof_lookup, ORACLE_SQL["asof_lookup"])
    reg("stream_purchase_changelog", jobs.stream_purchase_changelog, ORACLE_SQL["purchase_changelog"])
    reg("stream_top_items", jobs.stream_top_items, None)
    reg("stream_top_items_digest", jobs.stream_top_items_digest, TOP_ITEMS_DIGEST_SQL)
    reg("stream_due_messages", jobs.stream_due_messages, V.with_(V.LOG) + """,
h AS (SELECT *, 0 AS header_pos, CAST(floor(ev_value / 4) AS BIGINT) AS delay_seconds FROM log_t
      WHERE topic = 'test' AND event_type IN ('click', 'view')
      UNION ALL SELECT *, 1, CAST(floor(ev_value / 8) AS BIGINT) FROM log_t WHERE topic = 'test' AND event_type = 'view')
SELECT topic, partition, "offset", key_s AS key, value_s AS value, timestamp, CAST(header_pos AS INTEGER) AS header_pos,
       delay_seconds
FROM h WHERE delay_seconds > 0""")


_register_streams()
