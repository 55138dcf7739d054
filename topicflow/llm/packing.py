"""Best-fit packing: documents tokenized, cut at the sequence capacity and
packed by best-fit decreasing.

Best-fit decreasing sees pieces only through their lengths, so its run over
all pieces is computed from the histogram of lengths (at most ``capacity``
rows, whatever the corpus): a segment tree over remaining capacities finds
the tightest open bins, and bins of equal history are handled as one run.
Spark then numbers the pieces of each length and every piece looks its bin
up from its (length, number).
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, staged

CAPACITY = 2048
END_ID = 0
_CACHED_WORDS = 300_000  # bounds a task's memory, not its results

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _TightestBin:
    """Segment tree over remaining capacities 0..capacity: which of them
    have open bins, and the smallest such that is large enough."""

    def __init__(self, capacity: int):
        self.width = 1
        while self.width <= capacity:
            self.width *= 2
        self.used = [False] * (2 * self.width)

    def set(self, remaining: int, is_open: bool):
        i = remaining + self.width
        self.used[i] = is_open
        i //= 2
        while i:
            self.used[i] = self.used[2 * i] or self.used[2 * i + 1]
            i //= 2

    def at_least(self, size: int) -> int:
        """The smallest remaining capacity >= size with an open bin, or -1."""
        i = size + self.width
        if self.used[i]:
            return size
        while i > 1:
            if i % 2 == 0 and self.used[i + 1]:
                i += 1
                while i < self.width:
                    i = 2 * i if self.used[2 * i] else 2 * i + 1
                return i - self.width
            i //= 2
        return -1


def best_fit_runs(counts: dict[int, int], capacity: int = CAPACITY):
    """Best-fit decreasing over ``counts`` (length -> number of pieces).

    Returns (runs, number of bins).  A run (length, first, first_bin, each,
    offset) says: the pieces of this length numbered from ``first`` on (to
    the next run) go to the bins from ``first_bin`` on, ``each`` per bin, the
    first of a bin at ``offset``.  Exactly the bins of the one-by-one
    algorithm: a bin that just received a piece and can take another of the
    same length is again the tightest."""
    tree = _TightestBin(capacity)
    groups: dict[int, list[tuple[int, int]]] = {}  # remaining -> [(first bin, bins)]
    runs, bins = [], 0

    def put(remaining, first, n):
        if n and remaining:
            if remaining not in groups:
                groups[remaining] = []
                tree.set(remaining, True)
            groups[remaining].append((first, n))

    for size in sorted(counts, reverse=True):
        left, number = counts[size], 0
        while left:
            room = tree.at_least(size)
            if room < 0:  # open as many bins as the rest of this length needs
                room, first, n = capacity, bins, -(-left // (capacity // size))
                bins += n
            else:
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    tree.set(room, False)
            each = room // size
            full = min(n, left // each)
            rest = left - full * each if full < n else 0  # one more bin, partly filled
            runs.append((size, number, first, each, capacity - room))
            put(room - each * size, first, full)
            if rest:
                put(room - rest * size, first + full, 1)
            put(room, first + full + bool(rest), n - full - bool(rest))
            number += full * each + rest
            left -= full * each + rest
    return runs, bins


class WordIds(dict):
    """word -> ids: ids of white-space separated words as little-endian 32-bit bytes.

    The tokenizer's pre-tokenizer never joins characters across white space,
    and cuts a word of letters from punctuation that follows it, so a word is
    looked up as (letters, punctuation).  Lower-case Latin letters are in
    normal form already and go straight to the merge model; everything else
    goes through the whole tokenizer, as do texts that hold the string of a
    special token, which the tokenizer takes for that token."""

    _TAIL = b".,;:!?#$%&*|"

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        from .tokencount import byte_symbols

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        self._special = [t.content.encode().lower() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._model = self._tokenizer.model
        self._shown = {b: ch for ch, b in byte_symbols().items()}

    def _encode(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters
            ids = [t.id for t in self._model.tokenize(word.decode())]
        else:
            text = word.decode()
            if text.isalpha() and max(text) < "\u0250" and text.lower() == text:
                ids = [t.id for t in self._model.tokenize(word.decode("latin-1").translate(self._shown))]
            else:
                ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: bytes) -> bytes:
        body = word.rstrip(self._TAIL)
        if 0 < len(body) < len(word) and body.decode()[-1].lower()[-1].isalpha():
            ids = self[body] + self[word[len(body):]]
        else:
            ids = self._encode(word)
        self[word] = ids
        return ids

    def text(self, text: str) -> bytes:
        lower = text.encode().lower()
        if any(s in lower for s in self._special):  # strings of special tokens, in whatever case
            ids = self._tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        if len(self) > _CACHED_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, lower.split()))


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids, then
    END_ID, cut into pieces of at most ``capacity``.

    A task tokenizes each distinct word once (:class:`WordIds`) and joins the
    ids of a text's words.  A null text counts as empty (one piece of one
    id); repeated rows give repeated pieces; other columns are not read."""
    tokenizer_file = os.path.realpath(tokenizer_path)

    def run(batches):
        word_ids = WordIds(tokenizer_file)
        end = struct.pack("<I", END_ID)
        for batch in batches:
            out = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = word_ids.text(text.as_py() or "") + end
                n = len(ids) // 4
                for k, at in enumerate(range(0, n, capacity)):
                    stop = min(n, at + capacity)
                    for column, value in zip(out, (doc_id, k, at, stop - at, zlib.crc32(ids[4 * at:4 * stop]))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length`` in 1..capacity; read several times, pass a
    staged table) plus sequence_id and offset by best-fit decreasing.

    Only the histogram of lengths (at most ``capacity`` rows) reaches the
    driver; the plan it yields depends on the capacity, not on the corpus.
    Empty input gives an empty result; equal lengths are numbered by
    (doc_id, piece, start, ids_crc32), repeated rows take one place each."""
    counts = {r[0]: r[1] for r in pieces.groupBy("length").agg(F.count(F.lit(1))).collect()}
    runs, _ = best_fit_runs(counts, capacity)
    runs.sort()
    size, number, first_bin, each, offset = (np.array(c, dtype=np.int64) for c in zip(*runs)) if runs else [np.zeros(0, np.int64)] * 5
    # (length, number) as one sortable key; numbers stay below 2^50
    key = (size << 50) + number

    def place(batches):
        for batch in batches:
            n = batch.column("_number").to_numpy()
            length = batch.column("length").to_numpy()
            i = np.searchsorted(key, (length << 50) + n, side="right") - 1
            nth = n - number[i]
            cols = [c for name, c in zip(batch.schema.names, batch.columns) if name != "_number"]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(first_bin[i] + nth // each[i]), pa.array(offset[i] + nth % each[i] * length)],
                names=[x for x in batch.schema.names if x != "_number"] + ["sequence_id", "offset"])

    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "_number")
    ranked = ranked.select(*pieces.columns, "_number")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def packed_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str,
                     capacity: int = CAPACITY) -> DataFrame:
    """Documents tokenized, cut and packed: one row per piece with
    sequence_id and offset.  Cases as in :func:`token_pieces` (a null or
    empty text is one piece of one id) and :func:`pack` (repeated rows take
    one place each); a null doc_id stays null; an empty table gives no
    rows."""
    return pack(spark, staged(spark, token_pieces(docs, tokenizer_path, capacity), "pieces"), capacity)
