"""SQL twins (DuckDB dialect) of the derived topics of
:mod:`topicflow.sources.driver`; composed into the oracle queries."""

ORDERS = """orders_s AS (
  SELECT CASE WHEN (l.l_orderkey + l.l_linenumber) % 11 = 0 THEN 'X' ELSE '' END || CAST(o.o_custkey AS VARCHAR) AS user_name,
         CASE WHEN (l.l_orderkey + l.l_linenumber) % 13 = 0 THEN 'X' ELSE '' END || CAST(l.l_partkey AS VARCHAR) AS item_name,
         epoch_ms(o.o_orderdate) + (l.l_orderkey * 31 + l.l_linenumber * 7) % 360 * 5000 AS transaction_date, CAST(l.l_quantity AS INTEGER) AS quantity,
         l.l_orderkey AS order_key, l.l_linenumber AS line_number
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

USERS = """users_t AS (
  SELECT CAST(c_custkey AS VARCHAR) AS name, 'N' || CAST(c_nationkey AS VARCHAR) AS address,
         CASE WHEN c_nationkey = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
         CAST(15 + c_custkey % 30 AS INTEGER) AS age
  FROM customer)"""

ITEMS = """items_t AS (
  SELECT CAST(p_partkey AS VARCHAR) AS item_name, 'N' || CAST(p_partkey % 25 AS VARCHAR) AS address,
         p_type AS type, p_retailprice AS price
  FROM part)"""

ORDER_USER = """order_user AS (
  SELECT o.*, u.address AS user_address, u.gender AS gender, COALESCE(u.age, 0) AS age
  FROM orders_s o LEFT JOIN users_t u ON o.user_name = u.name)"""

OUI_W1 = """oui AS (
  SELECT ou.*, i.address AS item_address, i.type AS item_type, COALESCE(i.price, 0.0) AS item_price
  FROM order_user ou LEFT JOIN items_t i ON ou.item_name = i.item_name
  WHERE ou.user_address IS NOT NULL),
purchases AS (SELECT * FROM oui WHERE user_address = item_address)"""

OUI_ADULT = """adult AS (
  SELECT ou.*, i.address AS item_address, i.type AS item_type, COALESCE(i.price, 0.0) AS item_price
  FROM order_user ou LEFT JOIN items_t i ON ou.item_name = i.item_name
  WHERE ou.user_address IS NOT NULL AND ou.age BETWEEN 18 AND 35 AND i.type IS NOT NULL)"""


def java_hash_u32(s: str) -> str:
    """Unsigned low 32 bits of String.hashCode for BMP text."""
    return (f"list_reduce(list_transform(range(length({s})), lambda i: unicode({s}[i+1])), "
            f"lambda h, c: (h * 31 + c) % 4294967296, 0::BIGINT)")


def java_hash(s: str) -> str:
    u = java_hash_u32(s)
    return f"(CASE WHEN {u} >= 2147483648 THEN {u} - 4294967296 ELSE {u} END)"


LOG = f"""ev AS (
  SELECT CASE WHEN event_type = 'error' THEN 'errors' ELSE 'test' END AS topic,
         CAST(user_id AS VARCHAR) AS key_s, props AS value_s, ts AS timestamp, event_id,
         event_type, value AS ev_value
  FROM events),
log_p AS (
  SELECT *, CAST(({java_hash_u32('key_s')} % 2147483648) % 3 AS INTEGER) AS partition FROM ev),
log_t AS (
  SELECT *, row_number() OVER (PARTITION BY topic, partition ORDER BY timestamp, event_id) - 1 AS "offset"
  FROM log_p)"""

CHANGELOG = """chg AS (
  SELECT CAST(user_id AS VARCHAR) AS key, CASE WHEN event_type = 'error' THEN NULL ELSE props END AS value,
         ts, event_id AS seq
  FROM events)"""

TIMED_WORDS = """tw AS (
  SELECT event_type || ' ' || props AS value, ts AS timestamp, event_id AS seq FROM events)"""


def split_words(v: str) -> str:
    """Java ``toLowerCase().split(" ")`` as a DuckDB list."""
    return (f"(CASE WHEN {v} = '' THEN [''] WHEN rtrim(lower({v}), ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim(lower({v}), ' '), ' ') END)")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
