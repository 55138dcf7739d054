import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import ROWS, documents
from pyspark.sql import functions as F

from topicflow.llm import suffixtree as S
from topicflow.llm.common import crc_mod


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def test_base_counts_and_edges(spark):
    got = S.score(spark, documents(spark), crc_mod("doc_id", 7) == 2).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(t for r in ROWS if not held(r[0]) for t in tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = sorted((held(i), len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens(t)), 6))
                  for i, t, *_ in ROWS)
    assert sorted((r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n} and all(r.score < 0 for r in got)


def test_rare_words_come_by_the_join(spark, monkeypatch):
    monkeypatch.setattr(S, "FREQUENT_WORDS", 3)
    few = {(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in S.score(spark, documents(spark), crc_mod("doc_id", 7) == 2).collect()}
    monkeypatch.undo()
    assert few == {(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in S.score(spark, documents(spark), crc_mod("doc_id", 7) == 2).collect()}


def test_without_training_rows_and_empty(spark):
    rows = S.score(spark, documents(spark), F.lit(True)).collect()
    assert {r.base_score for r in rows} == {0.0} and {r.n_known for r in rows} == {0} and {r.train_tokens for r in rows} == {0}
    assert next(r for r in rows if r.doc_id == 8).score == pytest.approx(5 * math.log10(1 / 256), abs=1e-4)  # o n e blank end
    assert S.score(spark, documents(spark).limit(0), F.lit(False)).count() == 0


def test_contexts_pass_by_divergence_whatever_the_corpus_size(spark):
    key = lambda c, x: int.from_bytes(bytes(reversed(c)) + bytes([x]), "big")
    r = random.Random(3)
    text = bytes(r.choices(b"abcd ", [9, 5, 2, 1, 3], k=4000))
    counts = Counter(key(text[k - S.DEPTH:k], text[k]) for k in range(S.DEPTH, len(text)))
    for k in counts:
        counts[k] *= 500_000  # 2e9 positions
    counts[key(b"xyzxy", ord("a"))] = 60  # rare, and always before the same symbol
    counts[key(b"qqqqq", ord("a"))] = 1
    positions, levels = S.frequent_contexts(spark, spark.createDataFrame(list(counts.items()), "key long, n long"))
    assert positions == sum(counts.values())
    above, want, tree, depths = set(), [], 1, [dict(counts)]
    for _ in range(S.DEPTH):
        up = Counter()
        for k, n in depths[0].items():
            up[k >> 16 << 8 | k & 255] += n
        depths.insert(0, up)
    totals = [Counter() for _ in depths]
    for total, rows in zip(totals, depths):
        for k, n in rows.items():
            total[k >> 8] += n
    classes = len({k & 255 for k in counts} | {S.END}) + 1
    for d in range(S.DEPTH, 0, -1):
        gain = Counter()
        for k, n in depths[d].items():
            q = (depths[d - 1][k >> 16 << 8 | k & 255] + 1e-3) / (totals[d - 1][k >> 16] + 1e-3 * classes)
            gain[k >> 8] += n * math.log(n / totals[d][k >> 8] / q)
        above = {c >> 8 for c in above} | {c for c, g in gain.items() if g >= S.DIVERGENCE * math.log(positions)}
        tree += len(above)
        want.insert(0, {k: n for k, n in depths[d].items() if k >> 8 in above or d <= S.SHARD})
    got = [dict(zip(k.tolist(), n.tolist())) for k, n in levels]
    assert got == [dict(depths[0]), *want]
    assert S.build(positions, levels).contexts == tree
    assert any(k >> 8 == ord("y") for k in got[1]) and ord("y") in above  # 60 of 2e9 positions


def test_automaton_equals_longest_suffix_lookup():
    r = random.Random(5)
    texts = [[bytes(r.choice(b"abc") for _ in range(r.randint(1, 6))) for _ in range(r.randint(0, 60))] for _ in range(200)]
    keys, counts = S.count_contexts([S.symbols(w) for w in texts])
    brute = Counter()
    for w in texts:
        s = S.symbols(w)
        for k in range(S.DEPTH, len(s)):
            brute[(s[k - S.DEPTH:k], s[k])] += 1
    assert {(bytes((int(k) >> (8 * d)) & 255 for d in range(1, S.DEPTH + 1)), int(k) & 255): c for k, c in zip(keys, counts)} == brute
    positions, levels = int(counts.sum()), []
    level = {int(k): int(c) for k, c in zip(keys, counts)}
    for depth in range(S.DEPTH, -1, -1):
        total = Counter()
        for k, c in level.items():
            total[k >> 8] += c
        rows = sorted((k, c) for k, c in level.items() if total[k >> 8] >= 5)
        levels.insert(0, [np.array(x, np.int64) for x in zip(*rows)])
        up = Counter()
        for k, c in level.items():
            up[(k >> 16) << 8 | (k & 255)] += c
        level = up
    model = S.build(positions, levels)
    present = model.classes - 1
    p = 10.0 ** model.log_p.reshape(-1, model.classes).astype(float)
    assert np.allclose(p[:, :present].sum(1) + (256 - present) * p[:, present], 1, atol=1e-4)  # a distribution over bytes in every state
    streams = [S.symbols(w) for w in texts + [[b"zz", b"abz"]]]
    got = S.log_probabilities(model, streams)

    def walk(s):  # the state by reading all symbols from the start of the text
        state = total = 0
        for k, b in enumerate(s):
            at = state * model.classes + int(model.class_of[b])
            total += model.log_p[at] if k >= S.DEPTH else 0
            state = model.step[at]
        return total

    assert np.allclose(got, [walk(s) for s in streams], atol=1e-3)
    monkey = S._CHUNK
    try:
        S._CHUNK = 7  # chunks give the same
        assert np.allclose(S.log_probabilities(model, streams), got, atol=1e-3)
    finally:
        S._CHUNK = monkey
