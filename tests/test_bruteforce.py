"""Operators against plain-Python brute force on random small inputs."""

import datetime as dt
import random
from collections import defaultdict

from pyspark.sql import functions as F

from topicflow.operators import purchases, sequence, tables

BASE_MS = 1_478_822_400_000


def _top_brute(rows, size=3_600_000, adv=5_000, k=10):
    """rows: (type, item, qty, price, ts_ms, order_key, line)."""
    starts = set()
    for r in rows:
        s = (r[4] // adv) * adv
        while s > r[4] - size and s >= 0:
            starts.add(s)
            s -= adv
    out = set()
    for s in starts:
        by = defaultdict(list)
        for r in rows:
            if s <= r[4] < s + size:
                by[(r[0], r[1])].append(r)
        per_type = defaultdict(list)
        for (t, i), rs in by.items():
            first = min(rs, key=lambda r: (r[4], r[5], r[6], r[1], r[2]))
            per_type[t].append((i, sum(r[2] for r in rs), first[3], sum(r[2] * r[3] for r in rs)))
        for t, items in per_type.items():
            items.sort(key=lambda x: (-round(x[3], 6), x[0]))
            for rank, (i, c, p, a) in enumerate(items[:k], 1):
                out.add((s, s + size, t, i, c, p, round(a, 4), rank))
    return out


def test_top_items_vs_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    for n in range(60):
        item = rnd.randrange(14)
        rows.append((f"t{item % 3}", f"i{item:02d}", rnd.randint(1, 5),
                     float(rnd.choice([1.5, 2.0, 2.5, 4.0])), BASE_MS + rnd.randrange(0, 3 * 3_600_000, 500),
                     n, rnd.randint(1, 2)))
    df = spark.createDataFrame(rows, "item_type string, item_name string, quantity int, item_price double, "
                                     "transaction_date long, order_key long, line_number int")
    got = {(r.window_start, r.window_end, r.item_type, r.item_name, r["count"], r.price, round(r.amount, 4), r["rank"])
           for r in purchases.top_items_hopping(df).collect()}
    assert got == _top_brute(rows)
    # a small k makes the per-salt cut and the merge matter
    for salts in (1, 3):
        top = purchases.top_items_from_panes(purchases.pane_totals(df), k=2, salts=salts)
        got = {(r.window_start, r.window_end, r.item_type, r.item_name, r["count"], r.price, round(r.amount, 4),
                r["rank"]) for r in top.collect()}
        assert got == _top_brute(rows, k=2)


def _ts(s):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)


def test_asof_vs_brute_force(spark):
    rnd = random.Random(5)
    chg = [(rnd.choice("abc"), rnd.choice(["x", "y", None]), rnd.randrange(0, 4 * 86400, 600), n)
           for n in range(80)]
    st = [(i, rnd.choice("abcd"), rnd.randrange(0, 4 * 86400, 600)) for i in range(120)]
    c_df = spark.createDataFrame([(k, v, _ts(t), s) for k, v, t, s in chg],
                                 "key string, value string, ts timestamp, seq long")
    s_df = spark.createDataFrame([(i, k, _ts(t)) for i, k, t in st], "id int, key string, ts timestamp")
    got = {r.id: r.value for r in tables.asof_lookup(s_df, c_df).collect()}
    exp = {}
    for i, k, t in st:
        cands = [c for c in chg if c[0] == k and c[2] <= t]
        exp[i] = max(cands, key=lambda c: (c[2], c[3]))[1] if cands else None
    assert got == exp


def test_running_sums_vs_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("pq"), rnd.randrange(0, 50_000), n, rnd.randint(-5, 9)) for n in range(300)]
    df = spark.createDataFrame(rows, "k string, t long, n long, v long")
    got = {(r.k, r.n): (r.s, r.rn) for r in sequence.row_numbers(
        sequence.running_sums(df, ["k"], ["t", "n"], {"s": F.col("v")}),
        ["k"], ["t", "n"], name="rn").collect()}
    exp = {}
    for key in "pq":
        acc = 0
        for i, r in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))):
            acc += r[3]
            exp[(key, r[2])] = (acc, i)
    assert got == exp
