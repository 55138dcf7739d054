"""Golden results on the reference's 16-order sample (FIXTURES.md §1)."""

from pyspark.sql import Row, functions as F

from topicflow.operators import purchases, sweep, tables


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_ingest_fixture(fx_orders, fx_users, fx_items):
    assert fx_orders.count() == 16
    assert fx_users.count() == 4 and fx_items.count() == 4
    first = fx_orders.orderBy("transaction_date").first()
    assert (first.user_name, first.item_name, first.transaction_date, first.quantity) == \
        ("Jack", "iphone", 1478822401000, 3)


def test_purchase_by_region_gender(fx_orders, fx_users, fx_items):
    p = purchases.same_region_purchases(fx_orders, fx_users, fx_items)
    got = [(a, g, oc, ic, round(amt, 2)) for a, g, oc, ic, amt in
           _rows(purchases.purchase_by_region_gender(p), "address", "gender", "order_count",
                 "item_count", "amount")]
    assert got == sorted([("BJ", "male", 1, 3, 16166.64), ("SH", "female", 1, 3, 14666.64),
                          ("SZ", "male", 1, 3, 8006.64), ("GZ", "female", 1, 3, 5666.64)])


def test_purchase_by_gender(fx_orders, fx_users, fx_items):
    p = purchases.same_region_purchases(fx_orders, fx_users, fx_items)
    got = {g: round(a, 2) for g, a in _rows(purchases.purchase_by_gender(p), "gender", "amount")}
    assert got == {"male": 24173.28, "female": 20333.28}


def test_purchase_report_format(fx_orders, fx_users, fx_items):
    p = purchases.same_region_purchases(fx_orders, fx_users, fx_items)
    r = purchases.purchase_report(purchases.purchase_by_region_gender(p), money_digits=2)
    lines = {x.line_underscore for x in r.collect()}
    assert "BJ,male_1_3_16166.64" in lines
    assert {x.line_comma for x in r.collect()} >= {"SH,female,1,3,14666.64"}


def test_changelog_last_equals_batch(fx_orders, fx_users, fx_items):
    p = purchases.same_region_purchases(fx_orders, fx_users, fx_items)
    ch = purchases.purchase_changelog(p)
    last = {r.group_key: (r.order_count, r.item_count, round(r.amount, 2)) for r in
            ch.groupBy("group_key").agg(F.max_by(F.struct("order_count", "item_count", "amount"),
                                                 "order_count").alias("x"))
              .select("group_key", "x.*").collect()}
    assert last["BJ,male"] == (1, 3, 16166.64)


def test_top_items_hopping_golden(fx_orders, fx_users, fx_items):
    p = purchases.adult_purchases(fx_orders, fx_users, fx_items)
    top = purchases.top_items_hopping(p).cache()
    assert top.count() == 2892
    assert top.select("window_start").distinct().count() == 723
    assert top.agg(F.sum("count")).first()[0] == 39600
    starts = top.agg(F.min("window_start"), F.max("window_start")).first()
    assert (starts[0], starts[1]) == (1478818805000, 1478822415000)
    w = {r.item_type: (r.item_name, r["count"], r.price, round(r.amount, 2), r["rank"]) for r in
         top.where(F.col("window_start") == 1478822400000).collect()}
    assert w == {"phone": ("iphone", 14, 5388.88, 75444.32, 1), "pad": ("ipad", 13, 4888.88, 63555.44, 1),
                 "watch": ("iwatch", 15, 2668.88, 40033.2, 1), "pod": ("ipod", 13, 1888.88, 24555.44, 1)}
    first = {r.item_type: r["count"] for r in top.where(F.col("window_start") == 1478818805000).collect()}
    assert first == {"phone": 3, "pad": 4, "watch": 5, "pod": 4}
    last = {r.item_type: r["count"] for r in top.where(F.col("window_start") == 1478822415000).collect()}
    assert last == {"phone": 5, "pad": 4, "watch": 3, "pod": 3}
    assert top.where(F.col("window_end") - F.col("window_start") != 3600000).count() == 0


def test_top_items_edges(spark):
    """12 items of one type (top 10 kept, equal amounts tie-broken by name),
    first price kept when the price changes, null type dropped, age limits,
    an order exactly on a window end excluded."""
    base = 1478822400000
    users = spark.createDataFrame(
        [("a17", "X", "m", 17), ("a18", "X", "m", 18), ("a35", "X", "m", 35), ("a36", "X", "m", 36)],
        "name string, address string, gender string, age int")
    items = spark.createDataFrame([(f"i{j:02d}", "X", "t", float(j + 1)) for j in range(12)] +
                                  [("nt", "X", None, 1.0)],
                                  "item_name string, address string, type string, price double")
    rows = [("a18", f"i{j:02d}", base + 1000 * j, 1, j, 1) for j in range(12)]
    rows += [("a35", "i00", base + 20000, 2, 100, 1),        # i00: 1*1 + 2*1 = 3 = i02's amount
             ("a17", "i11", base + 1000, 50, 101, 1),        # too young
             ("a36", "i11", base + 1000, 50, 102, 1),        # too old
             ("a18", "nt", base + 1000, 5, 103, 1)]          # null type
    orders = spark.createDataFrame(rows, "user_name string, item_name string, transaction_date long, "
                                         "quantity int, order_key long, line_number int")
    p = purchases.adult_purchases(orders, users, items)
    assert p.where(F.col("item_name") == "nt").count() == 0
    top = purchases.top_items_hopping(p, size_ms=60000, advance_ms=5000)
    w = top.where(F.col("window_start") == base).orderBy("rank").collect()
    assert len(w) == 10
    assert [r.item_name for r in w][:3] == ["i11", "i10", "i09"]
    # i00 (1*1 + 2*1 = 3.0) ties with i02 (3*1): the name decides, i02 is 11th
    tail = [(r.item_name, r.amount) for r in w[-2:]]
    assert tail == [("i03", 4.0), ("i00", 3.0)]
    # an order exactly on a window end is not in that window: the order at
    # base+20000 first appears in the window starting at base-35000
    single = orders.where(F.col("order_key") == 100)
    t1 = purchases.top_items_hopping(purchases.adult_purchases(single, users, items), 60000, 5000)
    assert t1.agg(F.min("window_start")).first()[0] == base - 35000
    assert t1.count() == 12
    # price change: first price of the window is kept
    items2 = spark.createDataFrame([("i00", "X", "t", 1.0)], "item_name string, address string, type string, price double")
    o1 = orders.where(F.col("order_key") == 0)
    r1 = purchases.top_items_hopping(purchases.adult_purchases(o1, users, items2), 60000, 5000)
    assert {r.price for r in r1.collect()} == {1.0}


def test_order_user_miss_defaults(spark, fx_orders, fx_users):
    extra = spark.createDataFrame([("Nobody", "iphone", 1478822401000, 1, 0, 1)], fx_orders.schema)
    ou = tables.order_user(fx_orders.unionByName(extra), fx_users)
    r = ou.where(F.col("user_name") == "Nobody").first()
    assert r.age == 0 and r.user_address is None and r.gender is None


def test_null_gender_key_text(spark):
    users = spark.createDataFrame([("u", "A", None, 20)], "name string, address string, gender string, age int")
    items = spark.createDataFrame([("i", "A", "t", 2.0)], "item_name string, address string, type string, price double")
    orders = spark.createDataFrame([("u", "i", 1478822401000, 3, 1, 1)],
                                   "user_name string, item_name string, transaction_date long, quantity int, "
                                   "order_key long, line_number int")
    p = purchases.same_region_purchases(orders, users, items)
    rep = purchases.purchase_report(purchases.purchase_by_region_gender(p)).first()
    assert rep.line_underscore == "A,null_1_3_6.0"
    assert rep.group_key == "A,null"


def test_top_items_report_fixture(fx_orders, fx_users, fx_items):
    p = purchases.adult_purchases(fx_orders, fx_users, fx_items)
    rep = purchases.top_items_report(p, money_digits=2)
    assert rep.count() == 2892
    r = rep.where((F.col("window_start") == 1478822400000) & (F.col("item_type") == "phone")).first()
    assert r.report == "1478822400000,1478826000000,phone,iphone,14,5388.88,75444.32,1\n"
    assert r.n_items == 1


def test_top_items_report_vs_duckdb(spark):
    """T3 on the small driver tables: per type, number of reports, items and
    total text length equal the DuckDB oracle's."""
    import duckdb
    from conftest import SMALL
    from topicflow.plans import catalog
    from topicflow.sources.driver import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    exp = {tuple(r) for r in con.execute(
        "SELECT item_type, COUNT(*), SUM(n_items), SUM(length(report)) FROM (" + catalog.TOP_ITEMS_REPORT_SQL +
        ") GROUP BY item_type").fetchall()}
    got = {tuple(r) for r in catalog.QUERIES["top_items_report"](spark, SMALL).groupBy("item_type").agg(
        F.count(F.lit(1)), F.sum("n_items"), F.sum(F.length("report"))).collect()}
    assert got == exp


def test_null_gender_is_no_group(spark):
    rows = spark.createDataFrame([("f", 1, 2.0), (None, 1, 5.0)], "gender string, quantity int, item_price double")
    assert [tuple(r) for r in purchases.purchase_by_gender(rows).collect()] == [("f", 2.0)]


def test_dense_panes_stay_in_proportion(spark):
    """A pane every 5 s of several items: ranked segments are at most two a
    pane and block, however many window starts a pane covers; salts change
    nothing."""
    from topicflow.operators import sweep
    rows = [("t", f"i{(p * 7 + j) % 9}", p, 1 + (p * j) % 5, float((p * 31 + j * 17) % 23) + 0.1, 1.0 + p) for p in range(2000) for j in range(2)]
    panes = spark.createDataFrame(rows, "item_type string, item_name string, pane long, cnt long, amt double, first_price double")
    panes = panes.groupBy("item_type", "item_name", "pane").agg(F.sum("cnt").alias("cnt"), F.sum("amt").alias("amt"), F.min("first_price").alias("first_price"))
    one = purchases.ranked_segments(panes)
    assert one.count() <= 4 * panes.count() and one.count() <= 2 * 2000 + 10
    salted = sweep.flat(purchases.ranked_segments(panes, salt_panes=300))
    key = lambda d: sorted(map(tuple, purchases._expand_starts(d.where("rank <= 3 and seg < 200")).where("start < 200")
                               .select("start", "rank", "item_name", "count", "price", "amount").collect()))
    assert key(sweep.flat(one)) == key(salted)


def test_unknown_amounts_rank_last(spark):
    panes = spark.createDataFrame([("t", "a", 800, 1, None, 1.0), ("t", "b", 800, 2, 5.0, 2.0), ("t", "c", 800, 3, float("nan"), 3.0), ("t", "d", 801, 1, 0.1, 1.0),
                                   ("t", "d", 802, 1, 0.2, 2.0), ("t", "d", 803, 1, -0.3, 2.0)],
                                  "item_type string, item_name string, pane long, cnt long, amt double, first_price double")
    got = purchases.top_items_from_panes(panes, 60000, 5000).where("window_start = 800 * 5000").orderBy("rank").collect()
    assert [(r.item_name, r["count"], r.price, r.amount) for r in got[:2]] == [("b", 2, 2.0, 5.0), ("d", 3, 1.0, got[1].amount)]
    assert [(r.item_name, r.amount) for r in got[2:]] == [("a", None), ("c", None)] and abs(got[1].amount) < 1e-16


def test_window_takes_its_best_anew_only_when_they_change():
    w = sweep._Window(2)
    for name, amount in (("a", 5.0), ("b", 4.0), ("c", 3.0)):
        w.enter(name, 1, amount, 1.0)
    best = w.top()
    assert best == [("a", 1, 1.0, 5.0), ("b", 1, 1.0, 4.0)]
    w.enter("d", 1, 2.0, 1.0)           # below the best
    w.enter("c", 1, None, 9.0)          # a second pane without an amount
    w.leave("d")
    assert w.top() is best
    w.leave("c")                        # the pane without an amount is left
    w.leave("a")
    assert w.top() == [("b", 1, 1.0, 4.0), ("c", 1, 9.0, None)]


def test_report_lines_need_no_lambda_per_window(spark, fx_orders, fx_users, fx_items):
    report = purchases.top_items_report(purchases.adult_purchases(fx_orders, fx_users, fx_items))
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan and "lambda" not in plan.split("explode")[0]
