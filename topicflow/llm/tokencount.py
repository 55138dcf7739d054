"""Token counts by a linear longest-match automaton.

A trie over the vocabulary with failure links; each node knows how many
pieces are popped when its failure link is taken, so the greedy
longest-match piece count of a word comes from one left-to-right walk, and
no piece is ever built.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_END = 256  # the symbol after a word's last byte
_CACHED_WORDS = 500_000  # bounds a task's memory, not its results

COUNTS = "doc_id long, n_bytes long, n_words long, n_tokens long"


def byte_symbols() -> dict[str, int]:
    """Characters of a byte-level vocabulary -> byte values: printable bytes
    stand for themselves, the others for the characters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def read_vocabulary(path: str, end_mark: str = "</w>", skip: tuple[str, ...] = ()) -> list[tuple[int, ...]]:
    """Pieces of a byte-level ``tokenizers`` file as symbol tuples (bytes;
    WORD_END where a piece has the end mark)."""
    with open(path) as f:
        vocabulary = json.load(f)["model"]["vocab"]
    symbol = byte_symbols()
    pieces = []
    for piece in vocabulary:
        if piece in skip:
            continue
        ends = piece.endswith(end_mark) and len(piece) > len(end_mark)
        body = piece[:-len(end_mark)] if ends else piece
        if all(ch in symbol for ch in body):
            pieces.append((*(symbol[ch] for ch in body), *((WORD_END,) if ends else ())))
    return pieces


class LongestMatch:
    """The automaton.  ``count(word)``: number of pieces of the greedy
    longest match over the word's bytes and its end (the end alone is no
    piece); a word that cannot be matched through counts as one."""

    def __init__(self, pieces):
        child, is_piece, symbol_of, parent = [{}], [False], [-1], [-1]

        def add(piece):
            node = 0
            for s in piece:
                nxt = child[node].get(s)
                if nxt is None:
                    nxt = child[node][s] = len(child)
                    child.append({})
                    is_piece.append(False)
                    symbol_of.append(s)
                    parent.append(node)
                node = nxt
            return node

        for piece in pieces:
            if piece:
                is_piece[add(piece)] = True
        end = add((WORD_END,))
        bare_end = not is_piece[end]
        is_piece[end] = True
        fail, popped = [-1] * len(child), [0] * len(child)
        level = list(child[0].values())
        while level:  # breadth first: links lead to shallower nodes
            below = []
            for node in level:
                below.extend(child[node].values())
                if is_piece[node]:
                    fail[node], popped[node] = 0, 0 if node == end and bare_end else 1
                    continue
                at, n = fail[parent[node]], popped[parent[node]]
                while at >= 0 and symbol_of[node] not in child[at]:
                    n += popped[at]
                    at = fail[at]
                if at >= 0:
                    fail[node], popped[node] = child[at][symbol_of[node]], n
            level = below
        self.child, self.fail, self.popped = child, fail, popped

    def count(self, word: bytes) -> int:
        child, fail, popped = self.child, self.fail, self.popped
        node = n = 0
        for s in (*word, WORD_END):
            while s not in child[node]:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = child[node][s]
        while node > 0:
            n += popped[node]
            node = fail[node]
        return n if node == 0 else 1


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_words, n_tokens) of every whole text: words are
    separated by ASCII white space, A-Z lower-cased, each counted by the
    greedy longest match over the vocabulary.  Null and empty texts give
    zeros; repeated rows one row each; other columns are not read.  A task
    walks each distinct word once."""
    match = LongestMatch(read_vocabulary(vocabulary_path))  # as large as the vocabulary; sent to the tasks

    def run(batches):
        known: dict[bytes, int] = {}
        for batch in batches:
            rows = ([], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = (text.as_py() or "").encode()
                words = raw.lower().split()
                if len(known) > _CACHED_WORDS:
                    known.clear()
                for w in set(words):
                    if w not in known:
                        known[w] = match.count(w)
                for column, value in zip(rows, (doc_id, len(raw), len(words), sum(map(known.__getitem__, words)))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows],
                                             names=["doc_id", "n_bytes", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, COUNTS)
