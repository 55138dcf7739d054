"""Plain versions of operators that SQL cannot express, written anew: none
of them uses a function of the module that it checks, only the numbers of a
fitted model."""

import heapq
import math
import random
import zlib
from collections import Counter

import corpus_pipeline as P
import duckdb
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from topicflow.llm import langid, quality, queries, sharding

SF = "/root/testdata/sf0.001"
EDGE = chr(34) + ".,;:!?#$%&*|'()[]{}<>"


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def plain_language(m, text):
    """Language and score of a text, one trigram at a time."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    kept = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in text.lower().encode())
    kept = b" " + b" ".join(kept.split()) + b" "
    sums, n = [0.0] * len(m.bias), max(1, len(kept) - 2)
    for x, y, z in zip(kept, kept[1:], kept[2:]):
        f = (((x << 16 | y << 8 | z) * 2654435761) % (1 << 32)) >> 20
        for k in range(len(sums)):
            sums[k] += float(m.weights[f, k])
    certain = [sigmoid((s / n + float(b)) * float(c)) for s, b, c in zip(sums, m.bias, m.slope)]
    family = max(range(len(m.families)), key=lambda f: certain[f])
    members = m.families[family]
    won = {a: {} for a in members}
    for k, (a, b) in enumerate(m.pairs):
        if a in members:
            p = certain[len(m.families) + k]
            won[a][b], won[b][a] = p, 1 - p
    best = max(members, key=lambda a: (sum(p > 0.5 for p in won[a].values()), sum(won[a].values())))
    return m.languages[best], certain[family] * min([1.0, *won[best].values()])


def plain_quality(m, text):
    """Score of a text, one word at a time."""
    words, lines = (text or "").split(), [x for x in (text or "").split("\n") if x.strip()]
    features = np.zeros(144)
    if words:
        for w in words:
            body, tail = w.strip(EDGE), w[len(w.rstrip(EDGE)):][-3:]
            case = "u" if body.isupper() else "l" if body.islower() else "t" if body.istitle() else "m" if body else "-"
            shape = case + ("a" if body.isalpha() else "d" if body.isdigit() else "x") + str(min(len(body), 24) // 4) + tail
            features[:48] += m.vectors[zlib.crc32(body.lower().encode()) % 16384] / len(words)
            features[48:96] += m.vectors[16384 + zlib.crc32(shape.encode()) % 512] / len(words)
        codes = [zlib.crc32(w.strip(EDGE).lower().encode()) % 16384 for w in words]
        again = sum(a == b for a, b in zip(codes, codes[1:])) / (len(codes) - 1) if len(codes) > 1 else 0
        lines_again = 1 - len(set(lines)) / len(lines) if lines else 0
        features[96:] = again * m.vectors[-1] + lines_again * m.vectors[-2] + 0.05 * math.log1p(len(words)) * m.vectors[16384]
    hidden = np.tanh((features - m.center) / m.scale @ m.w1 + m.b1)
    return sigmoid((hidden @ m.w2 + m.b2) / m.temperature)


def plain_differencing(sizes, n):
    """Spread of the n sums after differencing, on sums alone."""
    parts = [tuple(sorted([s] + [0] * (n - 1))) for s in sizes]
    heap = [(-(p[-1] - p[0]), k, p) for k, p in enumerate(parts)]
    heapq.heapify(heap)
    k = len(heap)
    while len(heap) > 1:
        (_, _, a), (_, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        p = tuple(sorted(x + y for x, y in zip(a, reversed(b))))
        heapq.heappush(heap, (-(p[-1] - p[0]), k, p))
        k += 1
    return -heap[0][0]


def plain_packing(lengths, capacity):
    """Number of bins of best-fit decreasing, a piece at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


def test_sharding_is_as_tight_as_plain_differencing(spark):
    r = random.Random(9)
    docs = [(i, "x" * r.choice([5, 40, 900, r.randint(0, 3000)])) for i in range(800)] + [(900 + i, "copy " * 400) for i in range(40)] + [(990, None)]
    rows = sharding.shards(spark, spark.createDataFrame(docs, "doc_id long, text string"), 8).collect()
    groups, sums, shard_of = Counter(), Counter(), {}
    text = dict(docs)
    for x in rows:
        groups[text[x.doc_id] or ""] += x.size
        sums[x.shard] += x.size
        assert shard_of.setdefault(text[x.doc_id] or "", x.shard) == x.shard
        assert x.size == len(text[x.doc_id] or "") + 1
    assert max(sums.values()) - min(sums.values()) <= plain_differencing(list(groups.values()), 8) + 2
    assert sum(sums.values()) == sum(len(t or "") + 1 for _, t in docs)


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(P.STAGES)

    def go(name, before):
        after = P.staged(spark, stages[name](spark, before, SF), "plain")
        return before.collect(), after.collect(), after

    crc = lambda i, n: zlib.crc32(str(i).encode()) % n
    before, after, kept = go("quality classifier", docs)
    model = quality.fit(spark, docs, labels, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    scores = {r.doc_id: plain_quality(model, r.text) for r in before}
    assert all(abs(r.score - scores[r.doc_id]) < 1e-4 for r in quality.score(docs, model).collect())
    sure = {i for i, s in scores.items() if abs(s - P.LEAST_QUALITY) > 1e-4}
    assert {r.doc_id for r in after} & sure == {i for i in sure if scores[i] >= P.LEAST_QUALITY}
    known = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and crc(r.doc_id, 3) == 1 and r.doc_id in scores}
    assert sum((scores[i] >= 0.5) == q for i, q in known.items()) >= 0.8 * len(known)

    before, after, kept = go("language ID", kept)
    model = langid.fit(spark, spark.createDataFrame(before, docs.schema), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    want = {r.doc_id: plain_language(model, r.text) for r in before}
    for r in langid.predict(spark.createDataFrame(before, docs.schema), model).collect():
        assert r.lang_pred == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 1e-3
    sure = {i for i, (_, s) in want.items() if abs(s - P.LEAST_LANGUAGE) > 1e-3}
    assert {r.doc_id for r in after} & sure == {i for i in sure if want[i][0] != "und" and want[i][1] >= P.LEAST_LANGUAGE}
    held = [r for r in before if crc(r.doc_id, 4) == 2 and r.lang and want[r.doc_id][0] != "und"]
    assert sum(want[r.doc_id][0] == r.lang for r in held) >= 0.9 * len(held)

    before, after, kept = go("mixing sources to target weights", kept)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [(r.doc_id, r.text, r.lang, r.source) for r in before])
    chosen = con.execute(queries.ORACLE_SQL["op6_hierarchical_mixing"]).fetchall()
    assert Counter(r.doc_id for r in after) == Counter(r[0] for r in chosen)

    before, after, _ = go("best-fit packing", kept)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, lengths = Counter(), []
    for r in before:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            piece = ids[k:k + 2048]
            lengths.append(len(piece))
            want[(r.doc_id, k // 2048, k, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after) == want
    held = {}
    for r in after:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(held) == plain_packing(lengths, 2048)
    for pieces in held.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
