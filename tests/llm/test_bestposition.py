import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import documents

from topicflow.llm import bestposition, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]


def brute(docs, items, k):
    """Every document scored for every item."""
    found = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(found), sum(c.total() for _, c in found)
    df = Counter(w for _, c in found for w in c)
    out = []
    for item in {i for i, _ in items}:
        asked = {w for i, t in items if i == item for w in terms(t)}
        scores = []
        for i, c in found:
            m = 100 - 50 + (50 * c.total() * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 20 * m)) for w in asked if w in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def test_shard_equals_brute_force_and_stops_early():
    r, early = np.random.default_rng(4), 0
    for turn in range(60):
        n, vocabulary = int(r.integers(1, 3000)), 12
        size = int(r.integers(1, 4 * n))
        pairs = np.unique(r.integers(0, n, size) * vocabulary + r.integers(0, vocabulary, size))
        row, term = pairs // vocabulary, pairs % vocabulary
        impact = r.integers(1, 8, len(row)) if turn % 3 else (1e6 * r.random(len(row)) ** 8).astype(np.int64) + 1
        p = r.permutation(len(row))
        shard = bestposition.Shard(n, row[p], term[p], impact[p], vocabulary)
        for asked in ([0], [3, 5, 11], list(range(12)), []):
            scores = np.zeros(n, np.int64)
            some = np.isin(term, asked)
            np.add.at(scores, row[some], impact[some])
            for floor in (1, 6, int(scores.max()) if scores.max() else 1):
                rows, got, looked_up = shard.search(asked, 10, floor)
                order = np.lexsort((np.arange(n), -scores))[:10]
                order = order[scores[order] >= floor]
                assert rows.tolist() == order.tolist() and got.tolist() == scores[order].tolist()
                early += looked_up < (scores > 0).sum()
    assert early > 100


@pytest.mark.parametrize("postings, level_rows, item_bytes", [(1 << 20, 20_000, 1 << 20), (40, 3, 30)])
def test_search_equals_brute_force(spark, monkeypatch, postings, level_rows, item_bytes):
    monkeypatch.setattr(bestposition, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(bestposition, "LEVEL_ROWS", level_rows)
    monkeypatch.setattr(bestposition, "ITEM_BYTES", item_bytes)
    monkeypatch.setattr(bestposition, "FIRST_READ", 2)
    r = random.Random(6)
    vocabulary = ["The", "of", "é1", "中文", "x9", "Zebra", "a", "b", "c", "d_e", "42"]
    say = lambda n: " ".join(r.choices(vocabulary, range(len(vocabulary), 0, -1), k=n))
    docs = [(k, say(r.randint(0, 30))) for k in range(200)] + [(k, "the same Zebra") for k in range(500, 520)]
    docs += [(7, docs[7][1]), (None, "zebra zebra"), (None, None), (600, None), (601, ""), (602, " .-"), (603, "zebra " * 5000)]
    items = [(k, say(r.randint(1, 6))) for k in range(6)] + [(3, "x9, X9!"), (50, "zebra"), (51, None), (52, "..."), (53, "unknown"), (None, "42")]
    got = bestposition.search(spark, spark.createDataFrame([(*d, 1, "r") for d in docs], "doc_id long, text string, n int, item string"),
                              spark.createDataFrame([(*i, 2) for i in items], "item_id int, text string, rank int"), 8).collect()
    assert sorted([(x.item_id, x.rank, x.doc_id, x.score) for x in got], key=str) == brute(docs, items, 8)


def test_query_cases(spark, tmp_path):
    docs = documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, "the cat and the moon"), (2, "sans Numéro 345"), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [tuple(r) for r in queries.op12_best_position_search(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == brute([(r.doc_id, r.text) for r in docs.collect()], items, 50)
    docs.limit(0).write.parquet(f"{tmp_path}/e/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/e/benchmark.parquet")
    assert queries.op12_best_position_search(spark, f"{tmp_path}/e").collect() == []
    assert bestposition.search(spark, docs, spark.createDataFrame([], "item_id long, text string")).collect() == []
