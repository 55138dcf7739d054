import random

import public_tokenizers

from topicflow.llm.tokencount import WORD_END, LongestMatch, read_vocabulary, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


def greedy(pieces, word):
    """Greedy longest match piece by piece; the bare end mark is no piece."""
    symbols, at, n = (*word, WORD_END), 0, 0
    while at < len(symbols):
        stop = max((k for k in range(at + 1, len(symbols) + 1) if symbols[at:k] in pieces), default=None)
        if stop is None:
            return n if symbols[at:] == (WORD_END,) else 1
        n, at = n + 1, stop
    return n


def test_counts_equal_greedy_matching():
    r = random.Random(3)
    for _ in range(300):
        pieces = {tuple(r.choice([97, 98, 99, *([WORD_END] if k else [])]) for k in range(r.randint(1, 5))) for _ in range(r.randint(1, 12))}
        pieces = {p[:p.index(WORD_END) + 1] if WORD_END in p else p for p in pieces}
        match = LongestMatch(pieces)
        for _ in range(30):
            word = bytes(r.choice(b"abc") for _ in range(r.randint(1, 12)))
            assert match.count(word) == greedy(pieces, word), (pieces, word)


def test_real_vocabulary(spark):
    pieces = read_vocabulary(PATH)
    known = set(pieces)
    rows = [(1, "The quick brown fox, café!"), (2, None), (3, ""), (4, "x" * 300), (4, "x" * 300), (None, " \n\t"), (5, "中文 ok")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, n_tokens int")
    want = []
    for i, t in rows:
        words = (t or "").encode().lower().split()
        want.append((i, len((t or "").encode()), len(words), sum(greedy(known, w) for w in words)))
    got = [tuple(r) for r in token_counts(docs, PATH).collect()]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert token_counts(docs.limit(0), PATH).count() == 0
