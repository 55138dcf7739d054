"""Sharding, line rules and mixing, against brute force and their SQL."""

import random
import zlib
from collections import Counter

import duckdb
from cases import ROWS, documents, ids

from pyspark.sql import functions as F

from topicflow.llm import linefreq, mixing, queries, sharding


def _duck(rows, sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    out = con.execute(sql)
    names = [c[0] for c in out.description]
    return [dict(zip(names, r)) for r in out.fetchall()]


def _same(rows, spark_df):
    cols = sorted(spark_df.columns)
    assert sorted(rows[0]) == cols
    want = Counter(tuple(r[c] for c in cols) for r in rows)
    assert Counter(tuple(r[c] for c in cols) for r in spark_df.collect()) == want


def test_differencing_is_tight():
    r = random.Random(1)
    for _ in range(50):
        sizes = [r.randint(1, 10_000) for _ in range(r.randint(1, 300))]
        n = r.choice([2, 3, 8])
        shard = sharding.differencing(sizes, n)
        sums = [sum(s for s, k in zip(sizes, shard) if k == j) for j in range(n)]
        assert max(sums) - min(sums) <= max(sizes)
        if len(sizes) > 150:
            assert max(sums) - min(sums) <= 20
    # two largest combined oppositely ordered: the known difference of 8 7 6 5 4
    assert sharding.differencing([], 8) == []
    shard = sharding.differencing([8, 7, 6, 5, 4], 2)
    assert abs(sum(s if k else -s for s, k in zip([8, 7, 6, 5, 4], shard))) == 2


def test_shards(spark):
    rows = sharding.shards(spark, documents(spark), 8).collect()
    assert ids(rows) == ids(documents(spark).collect())
    of, slots = {}, {}
    text = {r[0]: r[1] for r in ROWS if r[0] is not None}
    for r in rows:
        if r.doc_id is not None:
            t = (text[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(t) + 1, zlib.crc32(t))
            of.setdefault(t, set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(len(s) == 1 for s in of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shards(spark, documents(spark).limit(0), 8).count() == 0


def test_small_groups_in_bundles(spark):
    docs = spark.createDataFrame([(i, "x" * (i * 37 % 101)) for i in range(3000)], "doc_id long, text string")
    rows = sharding.shards(spark, docs, 8, items=40).collect()
    sums = Counter()
    for r in rows:
        sums[r.shard] += r.size
    assert len(rows) == 3000 and max(sums.values()) - min(sums.values()) < 0.1 * min(sums.values())


def _repeated(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)})


def test_repeated_windows(spark, monkeypatch):
    r = random.Random(6)
    texts = ["", "a", "a a", "a a a", "a a a a", "a b c a b c", *(" ".join(r.choice("abcd") for _ in range(r.randint(1, 60))) for _ in range(200))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'h' as source")
    for bits in (22, 3):  # 3: texts of 7 words or more take the way of very long ones
        monkeypatch.setattr(linefreq, "_POSITION_BITS", bits)
        got = {x.doc_id: x.n_repeat_words for x in linefreq.line_rules(spark, docs).collect()}
        assert got == {i: _repeated(t.split()) for i, t in enumerate(texts)}


def test_line_rules_equal_their_sql(spark):
    r = random.Random(7)
    hot = "Subscribe to our 1 newsletter today!"
    rows = [(100 + i, "\n".join([hot.replace("1", str(i))] * (i % 3) + [" ".join(r.choice("abcdefgh") * 2 for _ in range(r.randint(1, 80))) for _ in range(r.randint(0, 4))]),
             "en", f"h{i % 2}") for i in range(320)] + [(1000 + i, hot + "\n" + "pad " * 3, "en", "h0") for i in range(30)]
    sql = queries.ORACLE_SQL["op4_line_frequency_rules"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = linefreq.line_rules(spark, docs)
    _same(_duck(rows, sql), out)
    assert out.where("removed_words > 0").count() > 50
    edge = [tuple(x[:4]) for k, x in enumerate(ROWS) if x[0] is not None and ROWS.index(x) == k]
    _same(_duck(edge, sql), linefreq.line_rules(spark, documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])))
    assert ids(linefreq.line_rules(spark, documents(spark)).collect()) == ids(documents(spark).collect())
    assert linefreq.line_rules(spark, documents(spark).limit(0)).count() == 0


def test_line_limit_does_not_grow_with_the_host(spark):
    """A line of 300 documents goes in hosts of 400 and of 4,000, and also
    when their texts are equal; one of 99 documents stays in both."""
    rows = [(h, i, ("banner of the host\n" if i < 300 else "rare banner\n" if i < 399 else "") + f"own line of {chr(97 + i % 26) * (1 + i // 26)}")
            for h, n in (("small", 400), ("large", 4000)) for i in range(n)]
    rows += [("copies", i, "the very same line\nand another") for i in range(500)]
    docs = spark.createDataFrame([(k, t, h) for k, (h, _, t) in enumerate(rows)], "doc_id long, text string, source string")
    got = {r.source: (r.n, r.w) for r in linefreq.line_rules(spark, docs).join(docs, "doc_id").where("removed_words > 0")
           .groupBy("source").agg({"doc_id": "count", "removed_words": "sum"}).toDF("source", "n", "w").collect()}
    assert got == {"small": (300, 1200), "large": (300, 1200), "copies": (500, 3000)}
    again = docs.where("source = 'small' and doc_id < 90")
    again = again.union(again).union(again)  # rows of one id count once
    assert linefreq.line_rules(spark, again).where("removed_words > 0").count() == 0


def test_cleaned_documents_lack_the_frequent_lines(spark):
    r = random.Random(11)
    hot = "Read MORE about 7 Ölçü: here!"
    rows = [(i, "\n".join(r.sample([hot.replace("7", str(i)), "", "12 -- 34", "  Own line\t" + "x" * (1 + i) + " ", "read more,  ABOUT ölçü here", "end"], 6)), f"h{i % 2}")
            for i in range(60)] + [(100, None, "h0"), (101, "", "h0"), (102, hot, "h0"), (102, hot, "h0"), (103, hot + "\n", "alone"), (104, hot, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    banner = {"read more about ölçü here", "end"}
    key = lambda x: " ".join("".join(c if c.isalpha() else " " for c in x.lower()).split())
    want = [(i, t if t is None or h not in ("h0", "h1") else "\n".join(x for x in t.split("\n") if key(x) not in banner)) for i, t, h in rows]
    out = linefreq.cleaned(spark, docs, line_docs=20)
    got = out.collect()
    assert sorted(((x.doc_id, x.text) for x in got), key=str) == sorted(want, key=str)
    assert all(sum(len(key(line).split()) for line in (x.text or "").split("\n")) == x.line_words - x.removed_words for x in got)
    _same([x.asDict() for x in linefreq.line_rules(spark, docs, line_docs=20).collect()], out.drop("text"))
    assert linefreq.cleaned(spark, docs.limit(0)).count() == 0


def _mix(spark, docs):
    return mixing.mix(spark, docs, queries.MIX_FRACTION, queries.MIX_EPOCHS, queries.MIX_WEIGHTS, queries.MIX_SEED).drop("row")


def test_mixing_equals_its_sql(spark):
    r = random.Random(8)
    rows = [(i, "w " * r.randint(0, 40), r.choice(["en", "de", "es", None]), r.choice(["src0", "src1", "a", "b", "c", None])) for i in range(900)]
    rows += [tuple(x[:4]) for x in ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as epoch", "2 as budget", "'x' as `order`", "3 as tokens")
    out = _mix(spark, docs)
    _same(_duck(rows, queries.ORACLE_SQL["op6_hierarchical_mixing"]), out)
    assert _mix(spark, docs.limit(0)).count() == 0


def _water(budget, children):
    """Shares of (weight, capacity) by repeated redistribution."""
    share, full = {}, set()
    while True:
        left = budget - sum(children[c][1] for c in full)
        weights = sum(children[c][0] for c in children if c not in full)
        more = {c for c in children if c not in full and children[c][1] * weights <= left * children[c][0]}
        if not more:
            return {c: children[c][1] if c in full else left * children[c][0] // weights for c in children}
        full |= more


def test_shortages_go_to_siblings_first(spark):
    docs = [(i, "w " * 9, lang, s) for i, (lang, s) in enumerate([("en", "src0")] * 20 + [("en", "z")] * 300 + [("de", "src0")] * 100)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    out = mixing.mix(spark, df, (1, 2), 1, {"source": {"src0": 9}}, "s", domain=F.lit("d")).groupBy("lang", "source").agg(F.sum("n_tokens").alias("n")).collect()
    got = {(r.lang, r.source): r.n for r in out}
    langs = _water(2100, {"en": (1, 3200), "de": (1, 1000)})
    want = {("en", s): v for s, v in _water(langs["en"], {"src0": (9, 200), "z": (1, 3000)}).items()} | {("de", "src0"): langs["de"]}
    assert got == {k: v // 10 * 10 for k, v in want.items()}


def test_nothing_from_below_a_weight_of_zero(spark):
    docs = [(i, "w " * 9, lang, s) for i, (lang, s) in enumerate([("en", "a")] * 50 + [("en", "b")] * 50 + [("de", "a")] * 30 + [("de", "c")] * 70)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")

    def taken(weights, fraction=(1, 2)):
        out = mixing.mix(spark, df, fraction, 1, weights, "s", domain=F.lit("d")).groupBy("lang", "source").agg(F.sum("n_tokens").alias("n")).collect()
        return {(r.lang, r.source): r.n for r in out}

    assert taken({"source": {"a": 0}}) == {("en", "b"): 500, ("de", "c"): 500}
    assert taken({"source": {"a": 0}}, (9, 10)) == {("en", "b"): 500, ("de", "c"): 700}
    assert taken({"lang": {"en": 0}}) == {("de", "a"): 300, ("de", "c"): 700}
    assert taken({"lang": {"en": 0, "de": 0}}) == {}
