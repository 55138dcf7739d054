"""Alignment of the tokens of two tokenizers, all texts of a batch in lockstep.

A text's A and B tokens cover the same bytes.  A state vector holds, for
every text of a batch, a pointer to an A and to a B token that overlap: each
step emits all those links at once, notes a cut where both tokens end at the
same byte, moves every pointer whose token ends first (both at a cut), and
drops the texts that have ended.  Long texts enter as several lanes of
LANE tokens or a little more, which begin at cuts, so that a batch takes few
steps whatever its longest text.

Corpus-wide counts of linked id pairs come from one aggregate over the
distinct pairs of every text; the most frequent pairs go to every task, all
others by a join.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import most_frequent, staged
from .tokencount import byte_symbols

BATCH_BYTES = 1 << 20
LANE = 256
KNOWN_PAIRS = 1 << 20   # most frequent pairs (24 bytes each) that are sent to all tasks
_NEAR = 64              # tokens behind a lane's end that may be its cut


# Fixed value: the pattern by which byte-level BPE cuts texts before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_OTHER_SCRIPT = re.compile("[^\x00-\u024f]")
_LONG_BLANK = re.compile(r"\s{1000}")


class ByteLevel:
    """Byte-level BPE of a tokenizers file; texts get a space in front.

    Where every merge makes the next id, ids are ranks, and tiktoken finds
    the same ids several times faster; it takes the texts of Latin letters
    without very long words, for which both libraries cut alike."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        symbols = byte_symbols()
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary, merges = file["model"]["vocab"], file["model"]["merges"]
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, n in vocabulary.items():
            self.bytes[n] = bytes(symbols[c] for c in token)
        pairs = ("".join(m.split(" ") if isinstance(m, str) else m) for m in merges)
        ranked = (len(vocabulary) == 256 + len(merges) and all(len(b) == 1 for b in self.bytes[:256])
                  and all(vocabulary[p] == 256 + k for k, p in enumerate(pairs))
                  and file["normalizer"] is None and file["pre_tokenizer"]["type"] == "ByteLevel"
                  and file["pre_tokenizer"]["use_regex"] and not file["pre_tokenizer"]["add_prefix_space"])
        self._fast = tiktoken.Encoding("ranks", pat_str=PATTERN, special_tokens={},
                                       mergeable_ranks={b: n for n, b in enumerate(self.bytes)}) if ranked else None

    def encode(self, texts: list[str]) -> list[list[int]]:
        out, others = [], []
        for k, t in enumerate(texts):
            plain = self._fast and not _OTHER_SCRIPT.search(t) and max(map(len, t.split()), default=0) < 1000 and not _LONG_BLANK.search(t)
            out.append(self._fast.encode_ordinary(" " + t) if plain else [])
            if not plain:
                others.append(k)
        for k, e in zip(others, self._tokenizer.encode_batch_fast([" " + texts[k] for k in others], add_special_tokens=False)):
            out[k] = e.ids
        return out


class Pieces:
    """A sentencepiece model, which itself puts a space in front."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(p[3:5], 16)]) if self._model.is_byte(n) else p.replace("▁", " ").encode()
                      for n, p in enumerate(self._model.id_to_piece(list(range(self._model.get_piece_size()))))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


def lanes(end_a: np.ndarray, end_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray):
    """First and last token (behind) of every lane, (a0, a1, b0, b1).

    ``end_a``, ``end_b``: byte behind every token, from the start of its
    text; ``at_a``, ``at_b``: first token of every text, and the total."""
    cut_a, cut_b = [], []
    for text in np.flatnonzero(np.diff(at_a) > LANE + _NEAR):
        own_a, own_b = end_a[at_a[text]:at_a[text + 1]], end_b[at_b[text]:at_b[text + 1]]
        probe = np.arange(LANE, len(own_a) - _NEAR, LANE)[:, None] + np.arange(_NEAR)
        place = np.searchsorted(own_b, own_a[probe])
        shared = own_b[place] == own_a[probe]       # the last ends are equal, so place stays inside
        some = np.flatnonzero(shared.any(1))
        first = shared[some].argmax(1)
        cut_a.append(at_a[text] + probe[some, first] + 1)
        cut_b.append(at_b[text] + place[some, first] + 1)
    a = np.unique(np.concatenate([at_a, *cut_a]))
    b = np.unique(np.concatenate([at_b, *cut_b]))
    return a[:-1], a[1:], b[:-1], b[1:]


def linked(end_a: np.ndarray, end_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray):
    """(a, b) of all links, and for every A and every B token whether a
    group ends with it.  Arguments as for :func:`lanes`; every text has
    tokens, and both its last tokens end at the same byte."""
    cut_a, cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    links_a, links_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    a, stop, b, _ = lanes(end_a, end_b, at_a, at_b)
    while len(a):
        links_a.append(a)
        links_b.append(b)
        x, y = end_a[a], end_b[b]
        cut = x == y
        cut_a[a[cut]] = True
        cut_b[b[cut]] = True
        a, b = a + (x <= y), b + (y <= x)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    return np.concatenate(links_a), np.concatenate(links_b), cut_a, cut_b


def interleaved(cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all A and all B tokens when every group lists its A tokens,
    then its B tokens."""
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    behind_a, behind_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
    before_b = np.concatenate([[0], behind_b])
    return np.arange(len(cut_a)) + before_b[group_a], np.arange(len(cut_b)) + behind_a[group_b]


_ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, counts array<int>"
_FULL = ", a_ids array<int>, b_ids array<int>, a_stops array<int>, b_stops array<int>"


def _lists(values: np.ndarray, at: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))


def aligned(docs: DataFrame, path_a: str, path_b: str, full: bool = False) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) aligned: a number ``row`` of its
    own, n_a, n_b, n_groups, n_links, groups_sha256, and the distinct linked
    id pairs (A id * size of the B vocabulary + B id) with how many links of
    the text hold them.  With ``full``: the ids of both tokenizers and the
    tokens up to every cut (a_stops, b_stops).

    Tokens are those of a space and the text.  Null and empty texts and those
    whose joined token bytes differ from that have no tokens: zeros, empty
    lists and an empty groups_sha256; repeated rows stay, each with its own
    number; an empty table gives no rows; other columns are not read."""
    path_a, path_b = os.path.realpath(path_a), os.path.realpath(path_b)

    def run(batches):
        a_side, b_side = ByteLevel(path_a), Pieces(path_b)
        n_a, n_b = len(a_side.bytes), len(b_side.bytes)
        length_a, length_b = (np.array(list(map(len, s.bytes))) for s in (a_side, b_side))
        shown = [b"%d%s" % (k, mark) for n, marks in ((n_a, b",|"), (n_b, b",;")) for mark in (marks[:1], marks[1:]) for k in range(n)]
        number = TaskContext.get().partitionId() << 40

        def batch_of(doc_ids, texts):
            nonlocal number
            some = [k for k, t in enumerate(texts) if t]
            ids = list(zip(a_side.encode([texts[k] for k in some]), b_side.encode([texts[k] for k in some])))
            keep = []
            for place, (k, (x, y)) in enumerate(zip(some, ids)):
                whole = b" " + texts[k].encode()
                if b"".join(map(a_side.bytes.__getitem__, x)) == whole and b"".join(map(b_side.bytes.__getitem__, y)) == whole:
                    keep.append(place)
            rows = np.array([some[p] for p in keep], np.int64)
            sides = []
            for side, length in ((0, length_a), (1, length_b)):
                at = np.concatenate([[0], np.cumsum([len(ids[p][side]) for p in keep])]).astype(np.int64)
                flat = np.concatenate([np.zeros(0, np.int64), *[np.array(ids[p][side], np.int64) for p in keep]])
                end = np.cumsum(length[flat])
                base = np.concatenate([[0], end])[at[:-1]]
                sides.append((flat, end - np.repeat(base, np.diff(at)), at))
            (id_a, end_a, at_a), (id_b, end_b, at_b) = sides
            link_a, link_b, cut_a, cut_b = linked(end_a, end_b, at_a, at_b)
            text_of = np.repeat(np.arange(len(rows)), np.diff(at_a))
            n_links = np.bincount(text_of[link_a], minlength=len(rows))
            pair, n = np.unique(text_of[link_a] * (n_a * n_b) + id_a[link_a] * n_b + id_b[link_b], return_counts=True)
            place_a, place_b = interleaved(cut_a, cut_b)
            order = np.empty(len(id_a) + len(id_b), np.int64)
            order[place_a] = id_a + n_a * cut_a
            order[place_b] = 2 * n_a + id_b + n_b * cut_b
            at = at_a + at_b
            digests = [hashlib.sha256(b"".join(map(shown.__getitem__, order[s:e].tolist()))[:-1]).hexdigest() for s, e in zip(at.tolist(), at[1:].tolist())]
            groups_a, groups_b = (np.concatenate([[0], np.cumsum(c)]) for c in (cut_a, cut_b))

            def column(values):
                out = np.zeros(len(texts), np.int64)
                out[rows] = values
                return out

            def starts(values):
                return np.concatenate([[0], np.cumsum(column(values))])

            sha = [""] * len(texts)
            for k, d in zip(rows.tolist(), digests):
                sha[k] = d
            pairs_at = starts(np.bincount(pair // (n_a * n_b), minlength=len(rows)))
            columns = {"row": pa.array(number + np.arange(len(texts))), "doc_id": pa.array(doc_ids, pa.int64()),
                       "n_a": pa.array(column(np.diff(at_a))), "n_b": pa.array(column(np.diff(at_b))),
                       "n_groups": pa.array(column(np.diff(groups_a[at_a]))), "n_links": pa.array(column(n_links)), "groups_sha256": pa.array(sha, pa.string()),
                       "pairs": _lists(pair % (n_a * n_b), pairs_at, pa.int64()), "counts": _lists(n, pairs_at, pa.int32())}
            if full:
                columns["a_ids"], columns["b_ids"] = _lists(id_a, starts(np.diff(at_a)), pa.int32()), _lists(id_b, starts(np.diff(at_b)), pa.int32())
                for side, cut, first, sums in (("a_stops", cut_a, at_a, groups_a), ("b_stops", cut_b, at_b, groups_b)):
                    stop = np.flatnonzero(cut) + 1
                    columns[side] = _lists(stop - np.repeat(first[:-1], np.diff(sums[first])), starts(np.diff(sums[first])), pa.int32())
            number += len(texts)
            return pa.RecordBatch.from_pydict(columns)

        doc_ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(doc_id)
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size >= BATCH_BYTES:
                    yield batch_of(doc_ids, texts)
                    doc_ids, texts, size = [], [], 0
        if texts:
            yield batch_of(doc_ids, texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _ALIGNED + (_FULL if full else ""))


def pair_counts(spark: SparkSession, rows: DataFrame, path_b: str) -> DataFrame:
    """(pair, n, best) of all rows of :func:`aligned`: links that hold the
    pair, and whether no other pair of its B id has more."""
    width = len(Pieces(path_b).bytes)
    n = rows.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
    n = staged(spark, n, "pairs")
    most = n.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("most"))  # a row per B id
    return n.join(most, F.col("pair") % width == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256) of every row of ``docs``; cases as in :func:`aligned`.
    count_sum adds, over the links of a text, how many links of all texts
    hold the same id pair; n_best counts the links whose pair is, for its B
    id, the most frequent (ties included)."""
    rows = staged(spark, aligned(docs, path_a, path_b), "aligned")
    counts = staged(spark, pair_counts(spark, rows, path_b), "counts")
    known = most_frequent(counts, "n", KNOWN_PAIRS).toArrow()  # KNOWN_PAIRS rows at most
    order = np.argsort(known.column("pair").to_numpy())
    held = spark.sparkContext.broadcast((known.column("pair").to_numpy()[order], known.column("n").to_numpy()[order],
                                         known.column("best").to_numpy()[order]))
    others = counts.count() > known.num_rows

    def run(batches):
        pairs, counted, best = held.value
        for batch in batches:
            pair, n = (batch.column(c).flatten().to_numpy() for c in ("pairs", "counts"))
            of = np.repeat(np.arange(batch.num_rows), batch.column("pairs").value_lengths().to_numpy())
            i = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1) if len(pairs) else np.zeros(len(pair), np.int64)
            found = pairs[i] == pair if len(pairs) else np.zeros(len(pair), bool)
            i = i[found]
            n_best, count_sum = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, of[found], n[found] * best[i])
            np.add.at(count_sum, of[found], n[found] * counted[i])
            left = np.concatenate([[0], np.cumsum(np.bincount(of[~found], minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in _KEPT] + [pa.array(n_best), pa.array(count_sum), _lists(pair[~found], left, pa.int64()), _lists(n[~found], left, pa.int32())],
                names=[*_KEPT, "n_best", "count_sum", "pairs", "counts"])

    out = rows.mapInArrow(run, _ALIGNED.replace(" pairs", " n_best long, count_sum long, pairs"))
    if others:
        out = staged(spark, out, "known")
        rare = out.select("row", F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("links"))
        rare = (rare.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
                                                            F.sum(F.col("links") * F.col("n")).alias("more_sum")))
        out = out.join(rare, "row", "left").withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
                                                         "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return out.select(*_KEPT[1:-1], "n_best", "count_sum", "groups_sha256")


_KEPT = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
