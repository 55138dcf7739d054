import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from topicflow.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def one_by_one(lengths, capacity):
    """Best-fit decreasing, a piece at a time: how full the bins are (bins
    with the same room are interchangeable)."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= n]
        if fits:
            b = min(fits, key=lambda x: x[0])
        else:
            bins.append(b := [capacity, []])
        b[1].append(n)
        b[0] -= n
    return sorted(sum(b[1]) for b in bins)


@pytest.mark.parametrize("seed", range(30))
def test_runs_equal_piece_by_piece_best_fit(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 10, 31, 64])
    lengths = [r.randint(1, r.choice([3, capacity])) for _ in range(r.randint(0, 150))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs, bins = packing.best_fit_runs(counts, capacity)
    content = {}
    for k, (size, number, first, each, offset) in enumerate(sorted(runs)):
        later = [x[1] for x in runs if x[0] == size and x[1] > number]
        for j in range(number, min(later, default=counts[size])):
            b = first + (j - number) // each
            content.setdefault(b, []).append((offset + (j - number) % each * size, size))
    assert set(content) == set(range(bins))
    for pieces in content.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= capacity
    assert sorted(sum(s for _, s in p) for p in content.values()) == one_by_one(lengths, capacity)


TEXTS = ["", None, "Hello, World!! it's the 2nd <|endoftext|> été ǅ straße ΣΣ 中文!,. a.b, ##x,", "the " * 5000,
         "tab\there\x0bnew\nline\r\x0c.", "DON'T can't, 'S's. x y  z 12,345. İx \x1c\x1d", "w" * 3000 + "," * 50,
         "ªºµ naïve, ÉCOLE. ñ (̃", "dup row", "dup row"]


def test_ids_equal_the_whole_tokenizer(tokenizer):
    ids = packing.WordIds(PATH)
    alphabet = "abéß'.,!|#1 ́\n'sStTÉİ中<>≠"
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choice(alphabet) for _ in range(r.randint(1, 40))) for _ in range(3000)]
    for t in texts:
        got = np.frombuffer(ids.text(t or ""), "<u4").tolist()
        assert got == ids_of(tokenizer, t)[:-1], t


def test_packs_every_document(spark, tokenizer):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(8, "dup row", "x", 1), (None, "no id", None, None)],
                                 "doc_id long, text string, length string, offset int")
    rows = packing.packed_documents(spark, docs, PATH).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(TEXTS):
        ids = ids_of(tokenizer, t)
        copies = 2 if i == 8 else 1
        want = [(k, a, min(2048, len(ids) - a), zlib.crc32(np.array(ids[a:a + 2048], "<u4").tobytes()))
                for k, a in enumerate(range(0, len(ids), 2048))] * copies
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == sorted(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 2048
    assert sorted(sum(n for _, n in p) for p in sequences.values()) == one_by_one([r.length for r in rows], 2048)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed_documents(spark, docs, PATH).count() == 0


def test_hot_length_is_numbered_in_buckets(spark):
    pieces = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
                                      F.lit(700).cast("long").alias("length"), F.lit(1).cast("long").alias("ids_crc32"))
    got = packing.pack(spark, pieces).groupBy("sequence_id").agg(F.collect_set("offset").alias("o"), F.count("*").alias("n"))
    assert got.count() == 2500 and got.where("n = 2 and array_contains(o, 0) and array_contains(o, 700)").count() == 2500


def test_strings_of_special_tokens_are_those_tokens(tokenizer):
    word_ids = packing.WordIds(PATH)
    for text in ("a <|endoftext|> b", "x<|startoftext|>y<|endoftext|>", "A <|ENDOFTEXT|> b", "<|endoftext|", "no <| such |>", "<|endoftext|>."):
        assert np.frombuffer(word_ids.text(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert 49407 in tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids
