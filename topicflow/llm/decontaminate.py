"""Benchmark decontamination by a generalised suffix automaton.

The words of the test items go into a suffix automaton, which accepts every
run of words of any item.  Texts are streamed through it word by word: the
state and the length of the longest run that ends at a word tell which
windows (``window`` consecutive item words, or a whole shorter item) end
there, and so the spans that items share with a text and the items.

Items are dealt to automata of at most MAX_BYTES of text, built in tasks and
kept in a table; AT_ONCE of them at most are broadcast at a time, and texts
are passed through all of them, whatever the size of the benchmark.
"""

from __future__ import annotations

import pickle
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import folded, folded_words, staged

WINDOW = 10
MAX_BYTES = 512 << 10   # item text of one automaton (one longer item: its pieces)
AT_ONCE = 4
PIECE_WORDS = 5_000     # longer items enter in pieces that share window - 1 words


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences: ``next`` (a dict of
    each state), suffix ``link`` and ``length`` of the longest run."""

    def __init__(self):
        self.next, self.link, self.length = [{}], [-1], [0]

    def _state(self, length: int, following: dict, link: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, w, q: int) -> int:
        """The state of the runs of ``q`` that are no longer than p's and w."""
        c = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def extend(self, p: int, w) -> int:
        """The state of the sequence that ended in ``p``, with ``w``."""
        q = self.next[p].get(w)
        if q is not None:
            return q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
        new = self._state(self.length[p] + 1, {}, 0)
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
        return new

    def add(self, words: list) -> None:
        p = 0
        for w in words:
            p = self.extend(p, w)


def build(items: list[tuple[str | None, list[bytes]]], window: int) -> bytes:
    """The automaton of (item id, words) as tables, pickled: word ids,
    transitions, links, lengths, and for every state its marks (length of a
    window that ends there, number of a set of items), its links' included."""
    ids: dict = {}
    texts = [(name, [ids.setdefault(w, len(ids)) for w in words]) for name, words in items if words]
    automaton = SuffixAutomaton()
    for _, words in texts:
        automaton.add(words)
    own: list[dict] = [{} for _ in automaton.next]
    for name, words in texts:
        v = 0
        for k, w in enumerate(words, 1):
            v = automaton.next[v][w]
            if k == len(words) < window:
                own[v].setdefault(k, set()).add(name)
            elif k >= window:  # the state of the last ``window`` words
                u = v
                while automaton.length[automaton.link[u]] >= window:
                    u = automaton.link[u]
                own[u].setdefault(window, set()).add(name)
    sets: dict = {}
    marks: list[tuple] = [()] * len(own)
    for v in sorted(range(1, len(own)), key=automaton.length.__getitem__):
        mine = tuple((n, sets.setdefault(frozenset(own[v][n]), len(sets))) for n in sorted(own[v]))
        marks[v] = marks[automaton.link[v]] + mine
    keys = np.array([v * len(ids) + w for v, d in enumerate(automaton.next) for w in d], np.int64)
    to = np.array([q for d in automaton.next for q in d.values()], np.int32)
    return pickle.dumps((list(ids), keys, to, np.array(automaton.link, np.int32), np.array(automaton.length, np.int32),
                         {v: m for v, m in enumerate(marks) if m}, [sorted(s, key=str) for s in sets]))


class Matcher:
    """Texts against one automaton of :func:`build`."""

    def __init__(self, tables: bytes):
        words, keys, to, link, length, self.marks, self.sets = pickle.loads(tables)
        self.ids = {w: k for k, w in enumerate(words)}
        self.follow = dict(zip(keys.tolist(), to.tolist()))
        self.link, self.length = link.tolist(), length.tolist()
        self.least = [1 << 60] * len(self.link)
        for v, m in self.marks.items():
            self.least[v] = m[0][0]

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Spans [first, behind last] of words inside windows (apart from
        each other), and the ids of the items."""
        spans, found, width = [], set(), len(self.ids)
        follow, link, length, least = self.follow.get, self.link, self.length, self.least
        v = n = 0
        for at, w in enumerate(map(self.ids.get, words), 1):
            if w is None:
                v = n = 0
                continue
            u = follow(v * width + w)
            while u is None:  # the root knows every word
                v = link[v]
                n = length[v]
                u = follow(v * width + w)
            v = u
            n += 1
            if n >= least[v]:
                for size, items in self.marks[v]:
                    if size <= n:
                        start = at - size
                        found.add(items)
                while spans and spans[-1][0] >= start:
                    spans.pop()
                if spans and spans[-1][1] >= start:
                    spans[-1][1] = at
                else:
                    spans.append([start, at])
        return spans, {name for s in found for name in self.sets[s] if name is not None}


def joined(spans: list) -> list:
    """The union of spans, as spans apart from each other."""
    out = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def without(text: bytes, spans: list) -> bytes:
    """``text`` less the words of the spans and what lies between them."""
    starts = np.frombuffer(b" " + folded(text) + b" ", np.uint8) != 32
    edges = np.flatnonzero(starts[1:] != starts[:-1])  # begin and end of every word
    out, at = [], 0
    for first, behind in spans:
        out.append(text[at:edges[2 * first]])
        at = edges[2 * behind - 1]
    return b"".join([*out, text[at:]])


def automata(spark: SparkSession, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row (tables: binary) per automaton of the ``items`` (item_id, text)."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = folded_words(text)
                long = len(words) > PIECE_WORDS
                for piece in [words[at:at + PIECE_WORDS] for at in range(0, len(words) - window + 1, PIECE_WORDS - window + 1)] if long else [words][:len(words)]:
                    held.append((name, piece))
                    n += sum(map(len, piece))
                    if n >= MAX_BYTES:
                        yield pa.RecordBatch.from_pydict({"tables": pa.array([build(held, window)], pa.binary())})
                        held, n = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"tables": pa.array([build(held, window)], pa.binary())})

    return staged(spark, items.coalesce(-(-size // MAX_BYTES) or 1).mapInArrow(run, "tables binary"), "automata")


_FOUND = [T.StructField("n_words", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
          T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])))]


def matches(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` (any columns with ``text``) as ``row``, with
    n_words, ``spans`` (words from start, before stop, inside an occurrence of
    a window of an item) and ``items`` (ids of the items whose windows occur,
    as strings, distinct).

    Windows: ``window`` consecutive words of an item, or all words of one
    that has fewer.  Null, empty and wordless texts have no words and no
    spans; repeated rows stay; items of equal id count once; an item without
    id marks its spans and is not named; items without words and an empty
    benchmark mark nothing; an empty table gives no rows; other columns may
    have any name."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    tables = automata(spark, items, window)
    turns = -(-tables.count() // AT_ONCE) or 1
    tables = (bytes(r.tables) for r in tables.toLocalIterator())
    for turn in range(turns):
        held = spark.sparkContext.broadcast(list(islice(tables, AT_ONCE)))

        def run(batches, held=held, first=turn == 0):
            matchers = [Matcher(t) for t in held.value]
            for batch in batches:
                texts = batch.column(0).field("text").cast(pa.binary())
                out = ([], [], [])
                for k in range(batch.num_rows):
                    words = folded_words(texts[k].as_py())
                    spans, names = ([], set()) if first else ([[s["start"], s["stop"]] for s in batch.column(3)[k].as_py()], set(batch.column(2)[k].as_py()))
                    for m in matchers:
                        more, ids = m.match(words)
                        spans += more
                        names |= ids
                    for column, value in zip(out, (len(words), sorted(names), [{"start": a, "stop": b} for a, b in joined(spans)])):
                        column.append(value)
                span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.string())),
                                                  pa.array(out[2], pa.list_(span))], names=["row", "n_words", "items", "spans"])

        rows = rows.mapInArrow(run, T.StructType([rows.schema["row"], *_FOUND]))
        if turn + 1 < turns:
            rows = staged(spark, rows, "matched")
    return rows


def coverage() -> Column:
    """Words inside the spans."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])


def decontaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = WINDOW,
                   longest: int = 200, share: float = 0.5) -> DataFrame:
    """``docs``, all columns, without what they share with the ``items``: the
    spans of :func:`matches` are cut out of the texts; rows with a span of
    more than ``longest`` words or more than ``share`` of their words in
    spans go whole.  Cases as in :func:`matches`; texts without spans stay
    as they are."""
    held = matches(spark, docs, items, window).withColumn("_hit", coverage())
    kept = held.where((F.col("_hit") <= F.col("n_words") * F.lit(share)) & ~F.exists("spans", lambda s: s["stop"] - s["start"] > longest))

    def run(batches):
        for batch in batches:
            texts = [t if t is None or not s else without(t, [(x["start"], x["stop"]) for x in s])
                     for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["row", "left"])

    left = (kept.select("row", F.col("row.text").cast("binary").alias("text"), "spans")
            .mapInArrow(run, T.StructType([held.schema["row"], T.StructField("left", T.BinaryType())])))
    return left.select(*[(F.decode("left", "UTF-8") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
