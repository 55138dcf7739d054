"""Language ID by hierarchical discrimination: the language family first,
then one-versus-one linear support vector machines between the languages of
that family.  Features are hashed letter trigrams (as UTF-8 bytes) of the
whole text.  Fitted on a bounded sample of documents per language."""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import TEXTS_IN_BATCH, slices, small_batches, staged

MAX_PER_LANGUAGE = 300  # labelled documents that a language is learned from, at most
MAX_LANGUAGES = 64      # languages that are learned: those of the most documents
BITS = 12               # trigrams are hashed into 2 ** BITS features
UNDETERMINED = "und"
_BLOCK = 1 << 16        # bytes of text scored at a time: each holds a weight for every machine meanwhile

# Closely related languages.
FAMILIES = {
    "germanic": ["da", "de", "en", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "pl", "ru", "sk", "uk"],
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}

_TO_BLANK = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


class Model(NamedTuple):
    languages: list[str]
    families: list[list[int]]         # languages of each family
    pairs: list[tuple[int, int]]      # one machine each, within a family
    weights: np.ndarray               # [2 ** BITS, families + pairs], per trigram
    bias: np.ndarray
    slope: np.ndarray                 # logistic slope of each margin


def letters(text: str | None) -> bytes:
    """Lower-case text as UTF-8 with everything ASCII but letters blank."""
    return b" " + b" ".join((text or "").lower().encode().translate(_TO_BLANK).split()) + b" "


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def trigram_ids(raw: np.ndarray) -> np.ndarray:
    b = raw.astype(np.uint32)
    return (((b[:-2] << 16) | (b[1:-1] << 8) | b[2:]) * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def features(text: str | None) -> np.ndarray:
    """Share of each hashed trigram among the text's trigrams."""
    ids = trigram_ids(np.frombuffer(letters(text), np.uint8))
    return (np.bincount(ids, minlength=1 << BITS) / max(1, len(ids))).astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, seed: int, epochs: int = 12, reg: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear support vector machine (hinge loss) by averaged stochastic
    subgradient steps; y is +1 or -1, classes weigh alike."""
    r = np.random.default_rng(seed)
    cost = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    w, b, mean_w, mean_b, n, step = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0, 0, 0
    for epoch in range(epochs):
        order = r.permutation(len(y))
        for at in range(0, len(order), 32):
            rows = order[at:at + 32]
            step += 1
            rate = 0.5 / (1 + 0.01 * step)
            miss = y[rows] * (x[rows] @ w + b) < 1
            g = (y[rows] * cost[rows] * miss) / len(rows)
            w = (1 - rate * reg) * w + rate * (g @ x[rows])
            b += 0.1 * rate * g.sum()
            if epoch >= epochs // 2:
                mean_w += w
                mean_b += b
                n += 1
    return mean_w / max(n, 1), mean_b / max(n, 1)


def fit_rows(languages_of_rows: list[str], x: np.ndarray) -> Model | None:
    """The hierarchy from rows of trigram shares and their languages."""
    languages = sorted(set(languages_of_rows))
    if not languages:
        return None
    lang = np.array([languages.index(a) for a in languages_of_rows])
    names = sorted({_FAMILY_OF.get(a, a) for a in languages})
    families = [[k for k, a in enumerate(languages) if _FAMILY_OF.get(a, a) == f] for f in names]
    pairs = [p for f in families for p in combinations(f, 2)]
    scale = 1 / (x.std(0) + 1e-4) / 10
    scaled = (x * scale).astype(np.float32)
    weights, bias, slope = [], [], []

    def machine(rows, y, seed):
        if len(set(y.tolist())) < 2:  # one family only: nothing to tell apart
            w, b = np.zeros(x.shape[1]), 1.0
        else:
            w, b = linear_svm(scaled[rows], y, seed)
        margins = scaled[rows] @ w + b
        weights.append(w * scale)
        bias.append(b)
        slope.append(2 / max(1e-6, float(np.median(np.abs(margins)))))

    everything = np.arange(len(lang))
    for k, f in enumerate(families):
        machine(everything, np.where(np.isin(lang, f), 1.0, -1.0), k)
    for k, (a, b) in enumerate(pairs):
        rows = np.flatnonzero((lang == a) | (lang == b))
        machine(rows, np.where(lang[rows] == a, 1.0, -1.0), 1000 + k)
    return Model(languages, families, pairs, np.stack(weights, 1).astype(np.float32), np.array(bias), np.array(slope))


def fit(spark: SparkSession, docs: DataFrame, train: Column, max_per_language: int = MAX_PER_LANGUAGE) -> Model | None:
    """The hierarchy from the documents with a language for which ``train``
    (a condition on doc_id) holds: for each of the MAX_LANGUAGES most frequent
    languages (ties by name) the ``max_per_language`` documents of the lowest
    hashes, or all if it has fewer.  Their features, at most 16 kB times both
    bounds, reach the driver.  Documents of null or wordless text teach
    nothing; None if there are none to learn from."""
    known = docs.where("lang is not null and text is not null").where(train)
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return None
    # a hash below which a language has twice as many documents as wanted, on
    # average, so that few rows are put in order
    whole = 1 << 62
    limit = F.create_map(*[F.lit(v) for r in counts for v in (r.lang, whole if r.n <= 4 * max_per_language else whole // r.n * 2 * max_per_language)])
    h = F.shiftright(F.xxhash64(F.col("doc_id"), F.lit("language sample")), 1).bitwiseAND(F.lit(whole - 1))
    ordered = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    sample = (known.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text", h.alias("h")).where(F.col("h") < limit[F.col("lang")])
              .withColumn("n", F.row_number().over(ordered)).where(F.col("n") <= max_per_language).select("doc_id", "lang", "text"))

    def run(batches):
        for batch in batches:
            kept = [(i, lang, features(t)) for i, lang, t in zip(*(c.to_pylist() for c in batch.columns)) if has_letter(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.string()),
                 pa.array([k[2].tobytes() for k in kept], pa.binary())], names=["doc_id", "lang", "x"])

    with small_batches(spark, TEXTS_IN_BATCH):
        t = staged(spark, sample.mapInArrow(run, "doc_id long, lang string, x binary"), "language-sample").toArrow()
    doc_id, lang, x = (t.column(c) for c in ("doc_id", "lang", "x"))
    order = sorted(range(t.num_rows), key=lambda k: (crc32(str(doc_id[k]).encode()), lang[k].as_py(), x[k].as_py()))
    if not order:
        return None
    # one row at a time: the sample stands in the driver's memory once
    shares = np.empty((len(order), 1 << BITS), np.float32)
    for to, k in enumerate(order):
        shares[to] = np.frombuffer(x[k].as_buffer(), np.float32)
    return fit_rows([lang[k].as_py() for k in order], shares)


def margins(model: Model, texts) -> np.ndarray:
    """[texts, machines] margins; a text's mean over its trigrams."""
    out = np.empty((len(texts), len(model.bias)))
    block, size, first = [], 0, 0

    def flush(upto):
        raw = np.frombuffer(b"".join(block), np.uint8)
        lengths = np.array([len(b) for b in block])
        starts = np.cumsum(lengths) - lengths
        each = model.weights[trigram_ids(raw)]
        # trigrams across two texts count for none
        for k in (1, 2):
            each[(starts[1:] - k)] = 0
        n = np.maximum(lengths - 2, 1)
        out[first:upto] = np.add.reduceat(each, starts, axis=0, dtype=np.float64) / n[:, None] + model.bias

    for k, t in enumerate(texts):
        raw = letters(t)
        block.append(raw if len(raw) > 2 else b"   ")
        size += len(raw)
        if size >= _BLOCK:
            flush(k + 1)
            block, size, first = [], 0, k + 1
    if block:
        flush(len(texts))
    return out


def predict_texts(model: Model | None, texts) -> tuple[list[str], np.ndarray]:
    """Language and score (0 to 1) of each text: the family of the largest
    margin, then the language with most votes of its machines (ties: larger
    sum of margins, then the earlier name).  The score is the logistic of
    the family's margin times that of the weakest vote won."""
    if model is None or not texts:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    certain = 1 / (1 + np.exp(-np.clip(margins(model, texts) * model.slope, -500, 500)))
    nf = len(model.families)
    family = certain[:, :nf].argmax(1)
    lang, score = np.zeros(len(texts), int), np.zeros(len(texts))
    for f, members in enumerate(model.families):
        rows = np.flatnonzero(family == f)
        if not len(rows):
            continue
        beats = np.ones((len(rows), len(members), len(members)))
        for k, (a, b) in enumerate(model.pairs):
            if a in members:
                i, j, p = members.index(a), members.index(b), certain[rows, nf + k]
                beats[:, i, j], beats[:, j, i] = p, 1 - p
        votes = (beats > 0.5).sum(2) + beats.sum(2) / (len(members) + 1)
        best = votes.argmax(1)
        lang[rows] = np.array(members)[best]
        score[rows] = certain[rows, f] * beats[np.arange(len(rows)), best].min(1)
    known = np.array([has_letter(t) for t in texts], bool)
    return [model.languages[k] if ok else UNDETERMINED for k, ok in zip(lang, known)], np.where(known, score, 0.0)


def predict_column(model: Model | None, texts) -> tuple[list[str], np.ndarray]:
    """:func:`predict_texts` of an Arrow column, some texts at a time."""
    parts = [predict_texts(model, some) for some in slices(texts)]
    return [lang for langs, _ in parts for lang in langs], np.concatenate([scores for _, scores in parts])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text.  ``und`` with score 0
    if the text is null, empty or has no letter, or nothing was learned;
    equal texts get equal results, repeated rows stay."""

    def run(batches):
        for batch in batches:
            langs, scores = predict_column(model, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def determined(docs: DataFrame, model: Model | None, least: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is determined with a
    score of at least ``least``.  Null texts and those without a letter go;
    repeated rows share their fate; an empty table gives no rows; other
    columns may have any name; without a model all rows go."""
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            langs, scores = predict_column(model, batch.column(place))
            yield batch.filter(pa.array([a != UNDETERMINED and s >= least for a, s in zip(langs, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
