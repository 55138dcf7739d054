import hashlib
import random
import re

import pytest

from pyspark.sql import functions as F

from topicflow.llm import decontaminate, queries

from cases import documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(texts, items, window=10):
    """(n_words, hit positions, item ids) of every text, window by window."""
    windows = set()
    for name, text in items:
        w = words(text)
        n = min(window, len(w))
        windows |= {(name, tuple(w[k:k + n])) for k in range(len(w) - n + 1) if n}
    out = []
    for text in texts:
        w = words(text)
        hit, found = set(), set()
        for name, g in windows:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    found.add(name)
        out.append((len(w), hit, {str(f) for f in found if f is not None}))
    return out


def compare(spark, texts, items, window):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, row string, spans int")
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {r.row.doc_id: r for r in decontaminate.matches(spark, docs, table, window).collect()}
    assert len(got) == len(texts)
    for k, (n, hit, found) in enumerate(brute(texts, items, window)):
        spans = {p for s in got[k].spans for p in range(s.start, s.stop)}
        assert (got[k].n_words, spans, set(got[k]["items"])) == (n, hit, found), (texts[k], items)
        assert got[k].row.row == "x" and len(got[k]["items"]) == len(found)


@pytest.mark.parametrize("limit", [512 << 10, 60])  # one automaton, and many with several turns
def test_matches_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "MAX_BYTES", limit)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 30 if limit < 100 else 5_000)
    r = random.Random(5)
    say = lambda n, a: " ".join(r.choice(a) for _ in range(n))
    few, more = ["a", "B", "c"], ["é9", "b", "The", "of", "中文", "x", "a"]
    items = [(k, say(r.randint(0, 14), few)) for k in range(25)] + [(100 + k, say(r.randint(8, 60), more)) for k in range(8)]
    items += [(3, items[0][1]), (None, say(12, more)), (50, None), (51, ""), (52, " .,"), (53, items[-1][1])]
    texts = [say(r.randint(0, 60), few) for _ in range(25)] + [say(r.randint(0, 60), more) for _ in range(25)]
    texts += [f"{say(20, more)}. {items[28][1].upper()}!{say(5, few)}", items[30][1].replace(" ", "\n-- "), None, "", " \t", "@@", items[30][1]]
    compare(spark, texts, items, 10)
    compare(spark, texts, items, 3)


def test_queries_cases(spark, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "the cat SAT on the mat, and looked at the moon"), (12, "one"), (2, "one"), (4, None)],
                          "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = queries.op13_benchmark_decontamination(spark, str(tmp_path)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows)
    want = [(0, 0, 0, 0, sha(""), False), (0, 5, 0, 0, sha(""), False)]
    want += [(d, 12, 11, 1, sha("1"), True) for d in (1, 2)] + [(d, 0, 0, 0, sha(""), False) for d in (3, 4, 5)]
    want += [(6, 90_000, 0, 0, sha(""), False)] + [(7, 4, 0, 0, sha(""), False)] * 2
    want += [(8, 1, 1, 2, sha("12,2"), True), (9, 1, 1, 2, sha("12,2"), True), (10, 2, 0, 0, sha(""), False), (11, 12, 0, 0, sha(""), False)]
    assert [g for g in got if g[0]] == sorted(w for w in want if w[0]) and sum(g[0] == 0 for g in got) == 2
    documents(spark).limit(0).write.parquet(f"{tmp_path}/e/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/e/benchmark.parquet")
    assert queries.op13_benchmark_decontamination(spark, f"{tmp_path}/e").collect() == []
    none = decontaminate.matches(spark, documents(spark), spark.createDataFrame([], "item_id long, text string"))
    assert none.where(F.size("spans") > 0).count() == 0 and none.count() == 14


def test_spans_are_cut_out(spark):
    item = "when in the course of human events it becomes necessary for one people to dissolve"
    docs = [(1, f"Before it: {item}, and AFTER é that come many more words so that the share is small enough to stay here"),
            (2, f"only {item}"), (3, "nothing at all"), (4, None), (5, ""), (6, "x " * 50 + item + "."), (7, item + " " + "y " * 40 + " " + item + " z")]
    docs = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, _hit string")
    items = spark.createDataFrame([("i", item)], "item_id string, text string")
    left = {r.doc_id: r.text for r in decontaminate.decontaminated(spark, docs, items).collect()}
    assert left == {1: "Before it: , and AFTER é that come many more words so that the share is small enough to stay here", 3: "nothing at all",
                    4: None, 5: "", 6: "x " * 50 + ".", 7: " " + "y " * 40 + "  z"}
    assert decontaminate.decontaminated(spark, docs, items).columns == docs.columns
    assert {r.doc_id for r in decontaminate.decontaminated(spark, docs, items, longest=14).collect()} == {3, 4, 5}
