"""LM scoring with a probabilistic suffix tree over the bytes of tokens.

A text is read as its lower-case words, each followed by a blank, and one
end symbol, so the probability of a token is that of its symbols.  Contexts
of up to ``DEPTH`` symbols (across words) are counted over all training
texts; a context is retained if its next-symbol distribution diverges enough
from that of its parent (the context without its oldest symbol), which is
tested in tasks by the two symbols before the next one, so the tree grows with
the corpus.  Distributions are smoothed with the parent's, the
root's with the uniform one over bytes.  Scoring walks an automaton whose
states are the longest suffixes that matter.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import most_frequent, staged

DEPTH = 5              # with the next symbol, 6 bytes of one long
SHARD = 2              # so many symbols before the next one name a shard of the contexts
DIVERGENCE = 1.0       # retained if count * KL divergence >= DIVERGENCE * ln(positions)
SMOOTHING = 60.0       # weight of the parent's distribution, in counts
FREQUENT_WORDS = 1 << 18  # at most so many words have their counts in every task; others are looked up by a join
END = 10               # end symbol of a text; also fills the context before its start
_CHUNK = 2048
_ROWS = 1024
_COUNTED_AT_ONCE = 1 << 23
_KNOWN_WORDS = 1_000_000


class Model(NamedTuple):
    class_of: np.ndarray   # byte -> symbol class
    step: np.ndarray       # [states * classes] next state
    log_p: np.ndarray      # [states * classes] log10 probability
    classes: int
    contexts: int


class WordNumbers(dict):
    """Words numbered as they come, with their 64-bit hashes."""

    def __init__(self):
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        h = xxhash.xxh64_intdigest(word)
        self.hashes.append(h - (1 << 64) if h >> 63 else h)
        return number


def symbols(words: list[bytes]) -> bytes:
    """A text's symbols, after DEPTH end symbols as its first context."""
    return b"\n" * DEPTH + (b" ".join(words) + b" \n" if words else b"\n")


def count_contexts(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of all windows of a context and its next symbol.  A
    key's bytes: the context, most recent symbol first, then the next one."""
    raw = np.frombuffer(b"".join(streams), np.uint8)
    lengths = np.array([len(s) for s in streams])
    key = np.zeros(len(raw) - DEPTH, np.int64)
    for k in range(1, DEPTH + 1):
        key |= raw[DEPTH - k:len(raw) - k]
        key <<= 8
    key |= raw[DEPTH:]
    scored = np.ones(len(key), bool)  # not where the next symbol belongs to a start
    starts = np.cumsum(lengths)[:-1]
    for k in range(DEPTH):
        scored[starts + k - DEPTH] = False
    key = key[scored]
    key.sort()  # in place: the largest array of a task stands in its memory once
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.diff(np.append(first, len(key)))


def slices(batches):
    """The batches in slices of so few rows that what a task makes of one is small beside the tree."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def gather(docs: DataFrame, train: Column) -> DataFrame:
    """(kind, key, n) over the training texts: kind 0 contexts with their
    next symbol, 1 words, 2 the number of texts; one row a key and task."""

    def run(batches):
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        numbers, word_counts, texts = WordNumbers(), np.zeros(0, np.int64), 0
        streams, size = [], 0

        def rows(kind, key, n):
            some = n > 0
            key, n = np.asarray(key, np.int64)[some], n[some]
            for at in range(0, len(key), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key[part]), kind, np.int32)), pa.array(key[part]), pa.array(n[part])],
                                                 names=["kind", "key", "n"])

        def merged():
            more, n = count_contexts(streams)
            both, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
            return both, np.bincount(at, np.concatenate([counts, n])).astype(np.int64)

        for batch in slices(batches):
            seen = []
            for text in batch.column(0):
                words = (text.as_py() or "").encode().lower().split()
                streams.append(symbols(words))
                size += len(streams[-1])
                seen.extend(map(numbers.__getitem__, words))
                texts += 1
                if size > _COUNTED_AT_ONCE:
                    keys, counts = merged()
                    streams, size = [], 0
            n = np.bincount(np.array(seen, np.int64), minlength=len(numbers.hashes))
            n[:len(word_counts)] += word_counts
            word_counts = n
            if len(numbers) > _KNOWN_WORDS:
                yield from rows(1, numbers.hashes, word_counts)
                numbers, word_counts = WordNumbers(), np.zeros(0, np.int64)
        if streams:
            keys, counts = merged()
        yield from rows(0, keys, counts)
        yield from rows(1, numbers.hashes, word_counts)
        yield from rows(2, [0], np.array([texts]))

    return docs.where(train).select("text").mapInArrow(run, "kind int, key long, n long")


def columns_of(df: DataFrame) -> list[np.ndarray]:
    """The columns of a small table, brought to the driver as arrays."""
    t = df.toArrow()
    return [t.column(c).to_numpy() for c in t.column_names]


def shorter(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The arrays (key, n) without the oldest symbol of the contexts."""
    key, of = np.unique(key >> 16 << 8 | key & 255, return_inverse=True)
    return key, np.bincount(of, n, minlength=len(key)).astype(np.int64)


def gains(key: np.ndarray, n: np.ndarray, parent_key: np.ndarray, parent_n: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(contexts, count * KL divergence of each from its parent) of one depth's sorted arrays."""
    context, of = np.unique(key >> 8, return_inverse=True)
    total = np.bincount(of, n, minlength=len(context))
    parents, parent_of = np.unique(parent_key >> 8, return_inverse=True)
    parent_total = np.bincount(parent_of, parent_n, minlength=len(parents))
    wanted = (key >> 16 << 8) | (key & 255)
    at = np.minimum(np.searchsorted(parent_key, wanted), len(parent_key) - 1)
    in_parent = np.where(parent_key[at] == wanted, parent_n[at], 0)
    q = (in_parent + 1e-3) / (parent_total[np.searchsorted(parents, context >> 8)][of] + 1e-3 * classes)
    return context, np.bincount(of, n * np.log(n / total[of] / q), minlength=len(context))


def frequent_contexts(spark: SparkSession, counts: DataFrame) -> tuple[int, list]:
    """(positions, per depth from 0 the arrays (key, n)): all contexts of up to
    SHARD symbols, and of the longer ones those that pass the divergence test
    of :func:`build` and their suffixes, with all their next symbols.  A key
    is a context and its next symbol.

    Contexts with the same last SHARD symbols are tested together in a task,
    as their parents are among them; what reaches the driver is the tree,
    whose size follows the corpus."""
    short = counts.groupBy(F.shiftright("key", 8 * (DEPTH + 1 - SHARD)).alias("context"), F.col("key").bitwiseAND(F.lit(255)).alias("next")).agg(F.sum("n").alias("n"))
    found = [columns_of(short.select((F.shiftleft("context", 8) + F.col("next")).alias("key"), "n").orderBy("key"))]  # at most 2 ** 24 rows
    for _ in range(SHARD):
        found.insert(0, shorter(*found[0]))
    positions, classes = int(found[0][1].sum()), len({*(found[0][0] & 255).tolist(), END}) + 1
    least = DIVERGENCE * np.log(max(positions, 2))

    def run(table):
        key, n = table.column("key").to_numpy(), table.column("n").to_numpy()
        order = np.argsort(key)
        levels = [(key[order], n[order])]
        for _ in range(DEPTH - SHARD):
            levels.append(shorter(*levels[-1]))
        depths, keys, ns, above = [], [], [], np.zeros(0, np.int64)
        for k, (key, n) in enumerate(levels[:-1]):
            context, gain = gains(key, n, *levels[k + 1], classes)
            above = np.union1d(above >> 8, context[gain >= least])
            mine = np.isin(key >> 8, above)
            depths.append(np.full(mine.sum(), DEPTH - k, np.int32))
            keys.append(key[mine])
            ns.append(n[mine])
        return pa.table({"depth": np.concatenate(depths), "key": np.concatenate(keys), "n": np.concatenate(ns)})

    tree = staged(spark, counts.select("key", "n", F.shiftright("key", 8 * (DEPTH + 1 - SHARD)).alias("shard"))
                  .groupBy("shard").applyInArrow(run, "depth int, key long, n long"), "contexts")
    return positions, found + [columns_of(tree.where(F.col("depth") == depth).select("key", "n").orderBy("key")) for depth in range(SHARD + 1, DEPTH + 1)]


def build(positions: int, levels: list) -> Model:
    """The automaton of the retained contexts, from the sorted (key, n)
    arrays of each depth."""
    present = sorted({int(x) for key, _ in levels for x in np.unique(key & 255)} | {END})
    classes = len(present) + 1  # the last one: bytes never seen
    class_of = np.full(256, classes - 1, np.uint8)
    class_of[present] = np.arange(len(present))

    # divergence tests against the parent
    contexts, owner, keep = [], [], []
    for depth, (key, n) in enumerate(levels):
        context, of = np.unique(key >> 8, return_inverse=True)
        ok = np.zeros(len(context), bool)
        if depth and len(key):
            ok = gains(key, n, *levels[depth - 1], classes)[1] >= DIVERGENCE * np.log(max(positions, 2))
        contexts.append(context)
        owner.append(of)
        keep.append(ok)
    for depth in range(len(levels) - 1, 0, -1):  # suffixes of a retained context stay too
        keep[depth - 1][np.searchsorted(contexts[depth - 1], contexts[depth][keep[depth]] >> 8)] = True

    # smoothed distributions, from the root down
    texts, log_of = [b""], [np.full((1, classes), np.log10(1 / 256), np.float32)]
    above, at_above = np.full((1, classes), 1 / 256), np.zeros(1, np.int64)  # distributions of the level above, and its contexts
    for depth, (key, n) in enumerate(levels):
        kept = np.flatnonzero(keep[depth]) if depth else np.arange(len(contexts[0]))
        v = np.zeros((len(kept), classes))
        place = np.full(len(contexts[depth]), -1)
        place[kept] = np.arange(len(kept))
        mine = place[owner[depth]] >= 0
        np.add.at(v, (place[owner[depth]][mine], class_of[key[mine] & 255]), n[mine])
        parent = above[np.searchsorted(at_above, contexts[depth][kept] >> 8)] if depth else above[:len(kept)]
        v = (v + SMOOTHING * parent) / (v.sum(1, keepdims=True) + SMOOTHING)
        if depth:
            # oldest symbol first; the key has the most recent one in its highest byte
            texts += [bytes((c >> (8 * k)) & 255 for k in range(depth)) for c in contexts[depth][kept].tolist()]
            log_of.append(np.log10(v).astype(np.float32))
        elif len(kept):
            log_of[0] = np.log10(v).astype(np.float32)
        if len(kept):
            above, at_above = v, contexts[depth][kept]
    log_of = np.concatenate(log_of)
    row_of = {t: k for k, t in enumerate(texts)}

    # states: all beginnings of retained contexts, shortest first
    states = sorted({c[:k] for c in texts for k in range(len(c) + 1)}, key=lambda s: (len(s), s))
    number = {s: k for k, s in enumerate(states)}
    step = np.zeros((len(states), classes), np.int32)
    log_p = np.empty((len(states), classes), np.float32)
    link = [0] * len(states)
    for k, s in enumerate(states):
        if k:
            link[k] = 0 if len(s) == 1 else int(step[link[number[s[:-1]]], class_of[s[-1]]])
        step[k] = step[link[k]] if k else 0
        log_p[k] = log_of[row_of[s]] if s in row_of else log_p[link[k]]
        for c, symbol in enumerate(present):
            nxt = number.get(s + bytes([symbol]))
            if nxt is not None:
                step[k, c] = nxt
    return Model(class_of, step.reshape(-1), log_p.reshape(-1), classes, len(texts))


def log_probabilities(model: Model, streams: list[bytes]) -> np.ndarray:
    """log10 probability of each stream of :func:`symbols`.  All texts walk
    together, cut into chunks; a state depends on the last DEPTH symbols
    only, so a chunk starts that many earlier, uncounted."""
    symbol = model.class_of[np.frombuffer(b"".join(streams), np.uint8)]
    lengths = np.array([len(s) for s in streams], np.int64)
    offsets = np.cumsum(lengths) - lengths
    chunks = -(-(lengths - DEPTH) // _CHUNK)
    text = np.repeat(np.arange(len(streams)), chunks)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    begin = offsets[text] + nth * _CHUNK
    size = np.minimum(lengths[text] - nth * _CHUNK, _CHUNK + DEPTH)
    order = np.argsort(-size, kind="stable")
    begin, size, text = begin[order], size[order], text[order]
    active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
    state, total = np.zeros(len(begin), np.int64), np.zeros(len(begin))
    for t, n in enumerate(active.tolist()):
        at = state[:n] * model.classes + symbol[begin[:n] + t]
        if t >= DEPTH:
            total[:n] += model.log_p[at]
        state[:n] = model.step[at]
    return np.bincount(text, total, minlength=len(streams))


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, word long, times long"


def score(spark: SparkSession, docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    contexts) of every row of ``docs``; learned from the rows where
    ``held_out`` does not hold.

    A null text is an empty one (its end is its only token); repeated rows
    each get a row, and each counts in training; without training rows every
    symbol has probability 1/256 and the base score is 0; an empty table
    gives no rows; other columns are not read."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    counts = staged(spark, gather(rows, ~F.col("held_out")).groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    positions, contexts = frequent_contexts(spark, counts.where("kind = 0").select("key", "n"))
    model = build(positions, contexts)
    n_contexts, sent = model.contexts, spark.sparkContext.broadcast(model)
    del contexts, model
    words = counts.where("kind = 1").select(F.col("key").alias("word"), F.col("n").alias("c"))
    totals = {r.kind: (r.n, r.distinct) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct")).collect()}
    ends = totals.get(2, (0, 0))[0]
    train_tokens = totals.get(1, (0, 0))[0] + ends
    z = train_tokens + totals.get(1, (0, 0))[1] + (ends > 0) + 1
    top_words, top_counts = columns_of(most_frequent(words, "c", FREQUENT_WORDS))
    by_word = np.argsort(top_words)
    top_words, top_counts = top_words[by_word], top_counts[by_word]
    log_z = float(np.log10(z))
    end_score, end_known = float(np.log10(ends + 1)) - log_z, int(ends > 0)

    def run(batches):
        numbers, count_of = WordNumbers(), np.zeros(0, np.int64)
        for batch in slices(batches):
            if len(numbers) > _KNOWN_WORDS:
                numbers, count_of = WordNumbers(), np.zeros(0, np.int64)
            streams, lengths, seen = [], [], []
            for text in batch.column(2):
                tokens = (text.as_py() or "").encode().lower().split()
                streams.append(symbols(tokens))
                lengths.append(len(tokens))
                seen.extend(map(numbers.__getitem__, tokens))
            hashes = np.array(numbers.hashes, np.int64)
            new = hashes[len(count_of):]  # -1: not among the frequent words
            if len(top_words):
                at = np.minimum(np.searchsorted(top_words, new), len(top_words) - 1)
                count_of = np.concatenate([count_of, np.where(top_words[at] == new, top_counts[at], -1)])
            else:
                count_of = np.concatenate([count_of, np.full(len(new), -1)])
            seen, lengths = np.array(seen, np.int64), np.array(lengths, np.int64)
            of = np.repeat(np.arange(len(lengths)), lengths)
            c = count_of[seen]
            often = c >= 0
            base = np.bincount(of[often], np.log10(c[often] + 1.0) - log_z, minlength=len(lengths)) + end_score
            known = np.bincount(of[often], minlength=len(lengths)) + end_known
            n = len(lengths)
            none = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(lengths + 1), pa.array(known), pa.array(base),
                 pa.array(log_probabilities(sent.value, streams)), none, none], names=[x.split()[0] for x in SCORED.split(", ")])
            if len(seen) > often.sum():
                pairs, times = np.unique(of[~often] * len(hashes) + seen[~often], return_counts=True)
                row = batch.column(0).to_numpy()[pairs // len(hashes)]
                m = len(pairs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                     pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()), pa.array(hashes[pairs % len(hashes)]), pa.array(times)],
                    names=[x.split()[0] for x in SCORED.split(", ")])

    scored = staged(spark, rows.select("row", "doc_id", "text", "held_out").mapInArrow(run, SCORED), "scored")
    sent.unpersist()
    rare = (scored.where("word is not null").select("row", "word", "times").join(words, "word", "left")
            .groupBy("row").agg(F.sum(F.col("times") * (F.log10(F.coalesce("c", F.lit(0)) + 1) - log_z)).alias("rare_score"),
                                F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known")))
    return (scored.where("word is null").drop("word", "times").join(rare, "row", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                    F.lit(train_tokens).cast("long").alias("train_tokens"),
                    (F.col("base_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"), "score",
                    F.lit(n_contexts).cast("long").alias("contexts")))
