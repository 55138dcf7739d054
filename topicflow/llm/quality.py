"""Quality classifier: random-indexing word vectors pooled per document, then
a two-layer numpy network with temperature-calibrated probabilities.

Fitted on a bounded sample of labelled documents (``MAX_SAMPLE``); every
other step reads whole texts of all documents.
"""

from __future__ import annotations

from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import TEXTS_IN_BATCH, slices, small_batches, staged

MAX_SAMPLE = 8000    # labelled documents the classifier is fitted on, about
WORD_IDS = 1 << 14   # words are hashed into so many vectors
SHAPES = 1 << 9      # and their shapes into so many
MARKS = 2            # repeated word, repeated line
DIM = 48
SIGNS = 6            # non-zeros of an index vector
WINDOW = 2
HIDDEN = 32
_CACHED_WORDS = 200_000
_VECTORS = WORD_IDS + SHAPES + MARKS


class Model(NamedTuple):
    vectors: np.ndarray  # [_VECTORS, DIM]
    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float


def index_vectors() -> np.ndarray:
    """Sparse ternary index vector of every id, by a fixed seed."""
    r = np.random.default_rng(20240601)
    out = np.zeros((_VECTORS, DIM), np.int32)
    for k in range(SIGNS):
        out[np.arange(_VECTORS), r.integers(0, DIM, _VECTORS)] += r.choice(np.array([-1, 1], np.int32), _VECTORS)
    return out


class Tokens:
    """Ids of a text: its words, their shapes, and marks for repetition."""

    def __init__(self):
        self.known: dict[str, int] = {}  # word id and, above it, shape id

    def _ids(self, word: str) -> int:
        body = word.strip(".,;:!?#$%&*|\"'()[]{}<>")
        case = "u" if body.isupper() else "l" if body.islower() else "t" if body.istitle() else "m" if body else "-"
        kind = "a" if body.isalpha() else "d" if body.isdigit() else "x"
        tail = word[len(word.rstrip(".,;:!?#$%&*|\"'()[]{}<>")):][-3:]
        shape = f"{case}{kind}{min(len(body), 24) // 4}{tail}"
        return crc32(body.lower().encode()) % WORD_IDS + crc32(shape.encode()) % SHAPES * WORD_IDS

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray, float]:
        """(word ids, shape ids, share of lines that repeat an earlier one)."""
        known = self.known
        words = text.split()
        if len(known) > _CACHED_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self._ids(w)
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        lines = [x for x in text.split("\n") if x.strip()]
        return ids % WORD_IDS, WORD_IDS + ids // WORD_IDS, 1 - len(set(lines)) / len(lines) if lines else 0.0


def neighbour_sums(texts, index: np.ndarray) -> np.ndarray:
    """Random indexing: for every id the sum of the index vectors of the
    words and shapes around its occurrences (integers, so any order of
    summation gives the same)."""
    sums = np.zeros((_VECTORS, DIM), np.int32)
    tokens = Tokens()
    for text in texts:
        words, shapes, _ = tokens.of(text)
        n = len(words)
        if not n:
            continue
        own = index[words] + index[shapes]
        around = np.zeros((n, DIM), np.int32)
        for k in range(1, min(WINDOW, n - 1) + 1):
            around[k:] += own[:-k]
            around[:-k] += own[k:]
        np.add.at(sums, words, around)
        np.add.at(sums, shapes, around)
    return sums


def word_vectors(sums: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Unit vectors of context plus the id's own index vector."""
    context = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1)
    own = index / np.maximum(np.linalg.norm(index, axis=1, keepdims=True), 1)
    return (0.5 * context + own).astype(np.float32)


def pooled(tokens: Tokens, vectors: np.ndarray, text: str) -> np.ndarray:
    """Mean vector of the words, of the shapes, and the marks' vectors by
    the share of words equal to the one before and of repeated lines."""
    words, shapes, lines_again = tokens.of(text)
    out = np.zeros(3 * DIM, np.float32)
    n = len(words)
    if n:
        for k, ids in enumerate((words, shapes)):
            values, counts = np.unique(ids, return_counts=True)
            out[k * DIM:(k + 1) * DIM] = (counts / n).astype(np.float32) @ vectors[values]
        again = float(np.mean(words[1:] == words[:-1])) if n > 1 else 0.0
        out[2 * DIM:] = again * vectors[-1] + lines_again * vectors[-2] + 0.05 * np.log1p(n) * vectors[WORD_IDS]
    return out


def fit_network(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, seed: int = 7, epochs: int = 60) -> Model:
    """Two layers (tanh, logit) by Adam; every fifth row is kept aside to
    choose the number of epochs and the temperature (one-dimensional search
    of the log loss)."""
    center, scale = x.mean(0), x.std(0) + 1e-4
    x = ((x - center) / scale).astype(np.float32)
    aside = np.arange(len(y)) % 5 == 4
    tx, ty, vx, vy = x[~aside], y[~aside], x[aside], y[aside]
    r = np.random.default_rng(seed)
    p = [r.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), r.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0

    def logits(q, at):
        return np.tanh(at @ q[0] + q[1]) @ q[2] + q[3][0]

    def loss(z, t):
        return float(np.mean(np.logaddexp(0, z) - t * z)) if len(t) else 0.0

    best, chosen = np.inf, [a.copy() for a in p]
    for _ in range(epochs):
        order = r.permutation(len(ty))
        for at in range(0, len(order), 64):
            rows = order[at:at + 64]
            h = np.tanh(tx[rows] @ p[0] + p[1])
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3][0], -30, 30))) - ty[rows]) / len(rows)
            dh = np.outer(d, p[2]) * (1 - h * h)
            grads = [tx[rows].T @ dh + 1e-4 * p[0], dh.sum(0), h.T @ d + 1e-4 * p[2], np.array([d.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= 0.004 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        now = loss(logits(p, vx), vy) if len(vy) else loss(logits(p, tx), ty)
        if now < best:
            best, chosen = now, [a.copy() for a in p]
    held, labels = (vx, vy) if len(vy) else (tx, ty)
    z = logits(chosen, held)
    temperature = min(np.geomspace(0.5, 5, 60), key=lambda t: loss(z / t, labels))
    return Model(vectors, center.astype(np.float32), scale.astype(np.float32), chosen[0].astype(np.float32),
                 chosen[1].astype(np.float32), chosen[2].astype(np.float32), float(chosen[3][0]), float(temperature))


def probabilities(model: Model, x: np.ndarray) -> np.ndarray:
    """Rounded, as sums in a batch depend on its shape in the last digits."""
    h = np.tanh(((x - model.center) / model.scale).astype(np.float64) @ model.w1 + model.b1)
    z = (h @ model.w2 + model.b2) / model.temperature
    return np.round(1 / (1 + np.exp(-np.clip(z, -500, 500))), 9)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, train: Column, max_sample: int = MAX_SAMPLE) -> Model | None:
    """The classifier, from rows of ``labels`` (doc_id, quality) for which
    ``train`` (a condition on doc_id) holds, joined to ``docs`` by doc_id.

    At most about ``max_sample`` of them are used: those whose hash is below
    the share max_sample / count (ids, labels and features of the sample are
    what reaches the driver).  Null labels and ids labelled both ways are
    left out.  None if there are not both classes."""
    known = (labels.where("doc_id is not null and quality in (0, 1)").where(train)
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("y"), F.max("quality").alias("z")).where("y = z"))
    parts = 1_000_000
    share = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("quality sample")), F.lit(parts))
    n = known.count()
    ids = known.where(share < F.lit(max(1, max_sample * parts // max(n, 1)))).select("doc_id", F.col("y").cast("int").alias("y"))
    # the sample is bounded, so it may be broadcast
    sample = staged(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
                    .join(F.broadcast(ids), "doc_id"), "quality-sample").coalesce(4)
    index = index_vectors()

    def sums(batches):
        total = np.zeros((_VECTORS, DIM), np.int32)
        for batch in batches:
            total += neighbour_sums((t.as_py() for t in batch.column(0)), index)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    total = np.zeros((_VECTORS, DIM), np.int64)
    with small_batches(spark, TEXTS_IN_BATCH):
        for row in sample.select("text").mapInArrow(sums, "sums binary").collect():  # 4 rows of fixed size
            total += np.frombuffer(row[0], np.int32).reshape(_VECTORS, DIM)
    vectors = word_vectors(total, index)

    def features(batches):
        tokens = Tokens()
        for batch in batches:
            x = [pooled(tokens, vectors, t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.binary())], names=["doc_id", "y", "x"])

    with small_batches(spark, TEXTS_IN_BATCH):
        rows = sample.select("doc_id", "text", "y").mapInArrow(features, "doc_id long, y int, x binary").collect()
    rows.sort(key=lambda r: (crc32(str(r.doc_id).encode()), r.doc_id, r.x))
    y = np.array([r.y for r in rows], np.float64)
    if len(set(y.tolist())) < 2:
        return None
    return fit_network(np.stack([np.frombuffer(r.x, np.float32) for r in rows]), y, vectors)


def text_scores(model: Model | None, tokens: Tokens, texts) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    return probabilities(model, np.stack([pooled(tokens, model.vectors, t or "") for t in texts])) if texts else np.zeros(0)


def column_scores(model: Model | None, tokens: Tokens, texts) -> np.ndarray:
    """:func:`text_scores` of an Arrow column, some texts at a time."""
    return np.concatenate([text_scores(model, tokens, some) for some in slices(texts)])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score): the probability of quality 1 of every whole text.
    A null text scores as the empty one, equal texts alike, repeated rows
    stay; without a model (no labels of both classes) the score is 0.5."""

    def run(batches):
        tokens = Tokens()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(column_scores(model, tokens, batch.column(1)))],
                                             names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def good(docs: DataFrame, model: Model | None, least: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``least``.
    Null and empty texts are scored like any other (equal to each other);
    repeated rows share their fate; an empty table gives no rows; other
    columns may have any name; without a model every score is 0.5."""
    place = docs.columns.index("text")

    def run(batches):
        tokens = Tokens()
        for batch in batches:
            yield batch.filter(pa.array(column_scores(model, tokens, batch.column(place)) >= least))

    return docs.mapInArrow(run, docs.schema)
