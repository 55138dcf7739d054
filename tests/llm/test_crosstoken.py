import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from cases import documents

from topicflow.llm import crosstoken, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def tokens(texts):
    """(A ids and their bytes, B ids and theirs) by the public libraries alone."""
    import base64

    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {int(n): base64.b64decode(b) for b, n in map(bytes.split, f)}
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    out = []
    for text in texts:
        a = t.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        bytes_a = [ranks[i] for i in a]
        pieces = [model.id_to_piece(i) for i in b]
        bytes_b = [bytes.fromhex(p[3:5]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        whole = (" " + (text or "")).encode()
        out.append((a, bytes_a, b, bytes_b) if text and b"".join(bytes_a) == whole == b"".join(bytes_b) else ([], [], [], []))
    return out


def brute(texts):
    """Columns of every text, all pairs of tokens compared."""
    rows, held = [], Counter()
    for a, bytes_a, b, bytes_b in tokens(texts):
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b)]
        spans = [[(e - len(x), e) for e, x in zip(end, side)] for end, side in zip(ends, (bytes_a, bytes_b))]
        links = [(i, j) for i, (s, e) in zip(a, spans[0]) for j, (u, v) in zip(b, spans[1]) if s < v and u < e]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, at = [], 0
        for c in cuts:
            groups.append(",".join(str(i) for i, (_, e) in zip(a, spans[0]) if at < e <= c) + "|" + ",".join(str(j) for j, (_, e) in zip(b, spans[1]) if at < e <= c))
            at = c
        rows.append((len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        held.update(links)
    most = {}
    for (_, j), n in held.items():
        most[j] = max(most.get(j, 0), n)
    return [(n_a, n_b, g, len(links), sum(held[x] == most[x[1]] for x in links), sum(held[x] for x in links), sha) for n_a, n_b, g, links, sha in rows]


TEXTS = ["Hello  world", " leading", "tail \n\t x", "naïve café — 日本語 🎉🎉", "a <|endoftext|> b <s> <0x0A> <unk>", "▁x", "ﬁ①½", "x" * 700, "1234567 89,10", "\n\n\n",
         "", None, "der Straßenbahnhaltestellenfahrplan", "Hello  world", "Σίσυφος, ё", "é   ​.", "tab\tand\r\nline", "\x00 nul \x07", "the of and the of and"]


@pytest.mark.parametrize("known, lane, size", [(1 << 20, 256, 1 << 20), (40, 3, 60), (0, 1, 1)])
def test_alignment_equals_brute_force(spark, monkeypatch, known, lane, size):
    monkeypatch.setattr(crosstoken, "KNOWN_PAIRS", known)
    monkeypatch.setattr(crosstoken, "LANE", lane)
    monkeypatch.setattr(crosstoken, "_NEAR", 4 if lane < 9 else 64)
    monkeypatch.setattr(crosstoken, "BATCH_BYTES", size)
    texts = TEXTS + [" ".join(TEXTS[k] or "" for k in range(n)) for n in range(1, 19, 4)]
    texts = [t for t in texts if not t or len(t) < 3000]
    docs = spark.createDataFrame([(k, t, "r") for k, t in enumerate(texts)], "doc_id long, text string, `row` string")
    got = {r.doc_id: r for r in crosstoken.alignment(spark, docs, A, B).collect()}
    assert len(got) == len(texts)
    for k, want in enumerate(brute(texts)):
        r = got[k]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == want, texts[k]


def test_lanes_and_links_of_random_tokens():
    r = np.random.default_rng(2)
    for _ in range(40):
        ends, total = ([], []), []
        for _ in range(5):
            n = int(r.integers(1, 900))
            for side in (0, 1):
                ends[side].append(np.unique(np.append(r.integers(1, n + 1, int(r.integers(0, 2 * n))), n)))
        at = [np.concatenate([[0], np.cumsum([len(e) for e in side])]) for side in ends]
        a, b, cut_a, cut_b = crosstoken.linked(*[np.concatenate(s) for s in ends], *at)
        want, cuts = set(), [0, 0]
        for t in range(5):
            x, y = ends[0][t], ends[1][t]
            first_x, first_y = np.concatenate([[0], x[:-1]]), np.concatenate([[0], y[:-1]])
            i, j = np.nonzero((first_x[:, None] < y) & (first_y < x[:, None]))
            want |= set(zip((i + at[0][t]).tolist(), (j + at[1][t]).tolist()))
            assert cut_a[at[0][t]:at[0][t + 1]].tolist() == np.isin(x, y).tolist() and cut_b[at[1][t]:at[1][t + 1]].tolist() == np.isin(y, x).tolist()
        assert len(a) == len(want) and set(zip(a.tolist(), b.tolist())) == want


def test_full_output_and_cases(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in crosstoken.aligned(docs, A, B, full=True).collect():
        a, bytes_a, b, bytes_b = tokens([TEXTS[r.doc_id]])[0]
        assert (r.a_ids, r.b_ids) == (a, b) and len(r.a_stops) == len(r.b_stops) == r.n_groups
        for x, y in zip(r.a_stops, r.b_stops):
            assert b"".join(bytes_a[:x]) == b"".join(bytes_b[:y])
        assert not a or (r.a_stops[-1], r.b_stops[-1]) == (len(a), len(b))
    rows = [r for r in documents(spark).collect() if (r.text or "").count(" ") < 1000]
    documents(spark).where("coalesce(length(text), 0) < 5000").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_token_alignment(spark, str(tmp_path)).collect()
    want = [(r.doc_id, *w) for r, w in zip(rows, brute([r.text for r in rows]))]
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted([tuple(r[c] for c in cols) for r in got], key=str) == sorted(want, key=str)
    long = documents(spark).where("length(text) > 5000")
    one = crosstoken.alignment(spark, long, A, B).first()
    assert one.n_a > 90_000 and one.n_links == one.n_a + one.n_b - one.n_groups
    documents(spark).limit(0).write.parquet(f"{tmp_path}/e/documents.parquet")
    assert queries.op11_token_alignment(spark, f"{tmp_path}/e").collect() == []


def test_both_ways_to_encode_agree():
    import random

    from tokenizers import Tokenizer
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    side, r = crosstoken.ByteLevel(A), random.Random(1)
    assert side._fast is not None
    alphabet = "abc DEF  12½²'sllt've\n\t\r\x0b\x0c\x1c\x85\xa0éßŁǅʼnªº.,-_<|>endoftext"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(1, 60))) for _ in range(3000)] + ["x" * 5000, " " * 3000 + "a", "日本 x", "it's we'LL"]
    assert side.encode(texts) == [e.ids for e in t.encode_batch([" " + x for x in texts], add_special_tokens=False)]
