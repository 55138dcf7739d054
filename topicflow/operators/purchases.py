"""Purchase analysis (W1-W3): region x gender totals, gender totals, the
change stream of those totals, and hourly top items per type on a 5-second
hop.  Input is the ``order_user_item`` stream of :mod:`topicflow.operators.tables`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from topicflow.functions.java import java_str
from topicflow.operators import sweep
from topicflow.operators.sequence import running_sums
from topicflow.operators.tables import order_user, order_user_item
from topicflow.schemas import (ADULT_MAX_AGE, ADULT_MIN_AGE, TOP_ITEMS_ADVANCE_MS, TOP_ITEMS_K,
                               TOP_ITEMS_WINDOW_MS)
from topicflow.session import staged

SALT_PANES = 100_000    # panes of a type and block that one task sweeps

# arrival order of the order stream; (order, line, item, quantity) is unique
# in the driver data, and rows equal in all five are interchangeable
ARRIVAL = ("transaction_date", "order_key", "line_number", "item_name", "quantity")


def same_region_purchases(orders: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """W1/W2 stream: orders of known users (address not null) for items in
    the user's own region.  ``==`` (not null-safe) on the addresses: the
    user address is already non-null, and the plain equality lets Catalyst
    turn both lookups into inner joins with the test inside the join."""
    oui = order_user_item(orders, users, items, user_filter=F.col("user_address").isNotNull())
    return oui.where(F.col("user_address") == F.col("item_address"))


def region_gender_key(address="user_address", gender="gender") -> Column:
    """The reference's grouping key text ``address + "," + gender``."""
    return F.concat(java_str(F.col(address)), F.lit(","), java_str(F.col(gender)))


def purchase_by_region_gender(purchases: DataFrame) -> DataFrame:
    """W1 (A1+A2): per (address, gender): orders, items bought, amount.
    Partial aggregation before the shuffle; the key set is tiny, so the
    final stage is trivially small even when a key holds most rows."""
    return (purchases.groupBy(F.col("user_address").alias("address"), "gender")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum("quantity").cast("long").alias("item_count"),
                 F.sum(F.col("quantity") * F.col("item_price")).alias("amount")))


def purchase_by_gender(purchases: DataFrame) -> DataFrame:
    """W2 (A3): total amount per gender; a record with a null grouping key is
    dropped."""
    return (purchases.where(F.col("gender").isNotNull()).groupBy("gender")
            .agg(F.sum(F.col("quantity") * F.col("item_price")).alias("amount")))


def purchase_report(totals: DataFrame, money_digits: int | None = None) -> DataFrame:
    """The two printed forms of a W1 row: ``key_oc_ic_amt`` and
    ``key,oc,ic,amt`` (double printed the JVM way; ``money_digits`` rounds
    first)."""
    amt = F.col("amount") if money_digits is None else F.round("amount", money_digits)
    key = F.concat(java_str(F.col("address")), F.lit(","), java_str(F.col("gender")))
    parts = [F.col("order_count").cast("string"), F.col("item_count").cast("string"),
             amt.cast("string")]
    return totals.select("address", "gender", key.alias("group_key"), "order_count",
                         "item_count", amt.alias("amount"),
                         F.concat_ws("_", key, *parts).alias("line_underscore"),
                         F.concat_ws(",", key, *parts).alias("line_comma"))


def purchase_changelog(purchases: DataFrame) -> DataFrame:
    """The table-to-stream view of W1: after every purchase, the updated
    totals of its key (every intermediate value, in arrival order), by the
    range-wise running sums of :mod:`topicflow.operators.sequence`."""
    p = purchases.withColumn("group_key", region_gender_key())
    return running_sums(
        p.select("group_key", *ARRIVAL, "item_price"),
        ["group_key"], [F.col(c) for c in ARRIVAL],
        {"order_count": F.lit(1).cast("long"),
         "item_count": F.col("quantity").cast("long"),
         "amount": F.col("quantity") * F.col("item_price")},
    ).drop("item_price")


def adult_purchases(orders: DataFrame, users: DataFrame, items: DataFrame,
                    min_age: int = ADULT_MIN_AGE, max_age: int = ADULT_MAX_AGE) -> DataFrame:
    """W3 stream: orders of known users aged ``min_age..max_age`` (inclusive),
    joined to items; rows without an item type are dropped (a null grouping
    key is skipped by the reference)."""
    flt = F.col("user_address").isNotNull() & F.col("age").between(min_age, max_age)
    return order_user_item(orders, users, items, user_filter=flt) \
        .where(F.col("item_type").isNotNull())


def filter_adults(orders: DataFrame, users: DataFrame,
                  min_age: int = ADULT_MIN_AGE, max_age: int = ADULT_MAX_AGE) -> DataFrame:
    """P5: the user-side filter of W3 on its own."""
    return order_user(orders, users).where(
        F.col("user_address").isNotNull() & F.col("age").between(min_age, max_age))


def top_items_hopping(purchases: DataFrame, size_ms: int = TOP_ITEMS_WINDOW_MS,
                      advance_ms: int = TOP_ITEMS_ADVANCE_MS, k: int = TOP_ITEMS_K,
                      block_ms: int | None = None, money_digits: int | None = None) -> DataFrame:
    """Per hopping window (``size_ms`` every ``advance_ms``, epoch
    aligned, ``[start, end)``, starts >= 0) and item type, the top ``k``
    items by amount: ``count`` = quantity sum, ``price`` = price of the
    item's first order in the window, ``amount`` = sum of quantity*price,
    ``rank`` 1..k (ties: item name).

    Plan — no 720-way Expand, and rows in proportion to panes, not to window
    starts, until the result is written out:

    1. pre-aggregate the stream to panes of ``advance_ms`` per (type, item)
       (partial aggregation: a hot item costs one row per pane and task);
    2. hand each pane to the time blocks (``block_ms`` of window starts,
       one window length by default) it reaches: at most
       ``size/block + 1`` (2) small rows per pane;
    3. shuffle once by (type, block, item salt) and sweep each group along
       the window starts (:mod:`topicflow.operators.sweep`): at most two rows
       a pane, one wherever the ``k`` best change; groups of many panes have
       several salts, whose results a second sweep merges;
    4. expand the ranked segments to their window starts."""
    return top_items_from_panes(staged(pane_totals(purchases, advance_ms), "panes"), size_ms, advance_ms, k, block_ms,
                                money_digits=money_digits)


def pane_totals(purchases: DataFrame, advance_ms: int = TOP_ITEMS_ADVANCE_MS) -> DataFrame:
    """W3 step 1: per (type, item, pane of ``advance_ms``): quantity, amount
    and the price of the first order (arrival order)."""
    first_key = F.struct(*[F.col(c) for c in ARRIVAL])
    return (purchases
            .select("item_type", "item_name", "quantity", "item_price", *ARRIVAL,
                    F.floor(F.col("transaction_date") / F.lit(advance_ms)).cast("long").alias("pane"))
            .groupBy("item_type", "item_name", "pane")
            .agg(F.sum("quantity").cast("long").alias("cnt"),
                 F.sum(F.col("quantity") * F.col("item_price")).alias("amt"),
                 F.min_by("item_price", first_key).alias("first_price")))


def ranked_segments(panes: DataFrame, size_ms: int = TOP_ITEMS_WINDOW_MS, advance_ms: int = TOP_ITEMS_ADVANCE_MS,
                    k: int = TOP_ITEMS_K, block_ms: int | None = None, salts: int | None = None,
                    salt_panes: int = SALT_PANES) -> DataFrame:
    """W3 steps 2 and 3 over pane totals (``item_type, item_name, pane, cnt,
    amt, first_price``; read twice): ``item_type, blk, seg, seg_end, top``,
    where ``top`` lists the ``k`` best items of the window starts ``seg`` to
    before ``seg_end`` (in panes).

    A group of more than ``salt_panes`` panes is dealt to several salts by
    item (``salts``: to so many, whatever its size), so that no task sorts
    all items of a hot type; each holds only what lies inside one window.
    Amounts add up exactly; a null or non-finite amount adds nothing, and an
    item without any ranks last."""
    if size_ms % advance_ms:
        raise ValueError("window size must be a multiple of the advance")
    L = size_ms // advance_ms                       # panes per window
    if block_ms is None:
        # one window length: a pane reaches at most 2 blocks.  Smaller blocks
        # add copies without shrinking a block's input much — every block
        # needs the panes of one window length after it.
        block_ms = size_ms
    BL = max(1, block_ms // advance_ms)             # window starts per block
    lo = F.greatest(F.col("pane") - F.lit(L - 1), F.lit(0))      # first start (pane units)
    blocks = F.sequence(F.floor(lo / BL).cast("long"), F.floor(F.col("pane") / BL).cast("long"))
    spread = (panes.withColumn("blk", F.explode(blocks))
              .withColumn("a", F.greatest(lo, F.col("blk") * BL))
              .withColumn("b1", F.least(F.col("pane"), F.col("blk") * BL + (BL - 1)) + 1))
    if salts is None:
        hot = (spread.groupBy("item_type", "blk").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > salt_panes)
               .select("item_type", "blk", F.ceil(F.col("__n") / salt_panes).cast("int").alias("__salts")))
        several = not hot.isEmpty()
        if several:
            spread = spread.join(hot, ["item_type", "blk"], "left")
    else:
        several, spread = salts > 1, spread.withColumn("__salts", F.lit(salts))
    salt = F.pmod(F.hash("item_name"), F.coalesce(F.col("__salts"), F.lit(1))) if several else F.lit(0)
    ranked = sweep.rank_panes(spread.withColumn("salt", salt), k)
    return (sweep.merge_salts(ranked, k) if several else ranked).drop("salt")


def _rounded(segments: DataFrame, money_digits: int | None) -> DataFrame:
    if money_digits is None:
        return segments
    return segments.withColumn("top", F.transform("top", lambda x: x.withField("amount", F.round(x["amount"], money_digits))))


def top_items_from_panes(panes: DataFrame, size_ms: int = TOP_ITEMS_WINDOW_MS,
                         advance_ms: int = TOP_ITEMS_ADVANCE_MS, k: int = TOP_ITEMS_K,
                         block_ms: int | None = None, starts: tuple | None = None,
                         salts: int | None = None, money_digits: int | None = None) -> DataFrame:
    """W3 steps 2-4 over pane totals; ``starts=(lo, hi)`` keeps window starts
    in ``[lo, hi)`` pane units.  ``money_digits`` rounds the printed amount
    (after ranking, once per segment rather than once per window row)."""
    ranked = ranked_segments(panes, size_ms, advance_ms, k, block_ms, salts)
    return windows_of_segments(ranked, size_ms, advance_ms, starts, money_digits)


def windows_of_segments(segments: DataFrame, size_ms: int = TOP_ITEMS_WINDOW_MS, advance_ms: int = TOP_ITEMS_ADVANCE_MS,
                        starts: tuple | None = None, money_digits: int | None = None) -> DataFrame:
    """W3 step 4: one row per window and rank."""
    out = _expand_starts(sweep.flat(_rounded(segments, money_digits)), starts)
    return out.select((F.col("start") * advance_ms).alias("window_start"),
                      (F.col("start") * advance_ms + size_ms).alias("window_end"),
                      "item_type", "item_name", "count", "price", "amount", "rank")


def _expand_starts(ranked: DataFrame, starts: tuple | None = None) -> DataFrame:
    out = ranked.withColumn("start", F.explode(F.sequence(F.col("seg"), F.col("seg_end") - 1)))
    if starts is not None:
        out = out.where((F.col("start") >= F.lit(starts[0])) & (F.col("start") < F.lit(starts[1])))
    return out


def top_items_digest(top: DataFrame, advance_ms: int = TOP_ITEMS_ADVANCE_MS) -> DataFrame:
    """Every row of a top-items result (numeric item names) in one row per
    (type, rank): windows, quantity, amount and price totals in exact cents,
    first and last window, and a checksum of items by window."""
    hp = (F.col("item_name").cast("long") % 1000003) * (F.floor(F.col("window_start") / advance_ms) % 1000)
    return (top.groupBy("item_type", "rank")
            .agg(F.count(F.lit(1)).alias("windows"), F.sum("count").cast("long").alias("items"),
                 F.sum(F.round(F.col("amount") * 100).cast("long")).alias("amount_cents"),
                 F.sum(F.round(F.col("price") * 100).cast("long")).alias("price_cents"),
                 F.min("window_start").alias("first_start"), F.max("window_start").alias("last_start"),
                 F.sum(hp).cast("long").alias("item_checksum")))


def top_items_report(purchases: DataFrame, size_ms: int = TOP_ITEMS_WINDOW_MS,
                     advance_ms: int = TOP_ITEMS_ADVANCE_MS, k: int = TOP_ITEMS_K,
                     money_digits: int | None = None) -> DataFrame:
    """One text per (window, type): lines
    ``start,end,type,item,count,price,sum,rank`` in rank order, each followed
    by a newline but the ``k``-th.

    Built per ranked segment: the part of each line after ``start,end`` is
    fixed within a segment, and the window bounds are put in front while
    expanding the segment to its window starts (as part of the delimiter of
    one ``array_join``; a lambda over the lines is interpreted line by line)."""
    panes = staged(pane_totals(purchases, advance_ms), "panes")
    ranked = _rounded(ranked_segments(panes, size_ms, advance_ms, k), money_digits)
    lines_of = F.transform("top", lambda x, i: F.concat_ws(
        ",", java_str(F.col("item_type")), java_str(x["item_name"]), x["count"].cast("string"), x["price"].cast("string"),
        x["amount"].cast("string"), (i + 1).cast("string")))
    per_seg = ranked.select("item_type", "seg", "seg_end", F.size("top").alias("n"), lines_of.alias("ls"))
    out = _expand_starts(per_seg)
    ws = (F.col("start") * advance_ms)
    prefix = F.concat(ws.cast("string"), F.lit(","), (ws + size_ms).cast("string"), F.lit(","))
    lines = F.when(F.col("n") > 0, F.concat(prefix, F.call_function("array_join", F.col("ls"), F.concat(F.lit("\n"), prefix)))).otherwise(F.lit(""))
    return out.select(ws.alias("window_start"), (ws + size_ms).alias("window_end"), "item_type",
                      F.col("n").alias("n_items"),
                      F.concat(lines, F.when(F.col("n") < k, F.lit("\n")).otherwise(F.lit(""))).alias("report"))
