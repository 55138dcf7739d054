"""Ranked lexical search by the Best Position Algorithm.

Documents are indexed in shards of a bounded number of postings, each built
and searched inside one task.  A shard has, for every query term, its
postings by falling impact (for sorted access) and by document (for direct
access).  A search reads all lists of an item in step; a document met for
the first time is looked up in every list, which gives its whole score and
marks its positions as seen.  The best position of a list is the last of its
unbroken run of seen positions, and lies at or beyond the last one read: no
unseen document scores more than the sum of the impacts at the best
positions, and reading stops when that is strictly below the k-th score.

Levels keep what shards return small: a document belongs to one of some
levels of which each is 16 times smaller than the one before, by a hash.  The
smallest is searched first, and its k-th scores are thresholds for the next,
so that all shards together return about 16 k rows an item at any size.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import folded_words, staged

K = 50
ITEM_BYTES = 512 << 10      # terms of the items that are searched at once (bytes of text)
SHARD_POSTINGS = 2 << 20
LEVEL_ROWS = 20_000         # the smallest level has about as many rows at least
FIRST_READ = 32             # positions of every list read first; then as many again, twice as many, ...


class Shard:
    """Documents (rows in the order of ties) with their postings.

    ``row``, ``term``: of every posting, ``impact``: what it adds to a score
    (positive); terms count from 0 to ``n_terms``."""

    def __init__(self, n_rows: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        by_row = np.lexsort((row, term))
        self.n_rows, self.row, self.impact = n_rows, row[by_row], impact[by_row]
        self.start = np.searchsorted(term[by_row], np.arange(n_terms + 1))
        # postings by falling impact, and the place of each among those of its term
        self.falling = np.lexsort((self.row, -self.impact, term[by_row]))
        self.place = np.empty(len(row), np.int64)
        self.place[self.falling] = np.arange(len(row)) - self.start[term[by_row]]

    def search(self, terms: list[int], k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, scores) of the k best, scores at least ``floor`` (> 0),
        the highest first and ties by row; and how many rows were looked up."""
        lists = [(int(self.start[t]), int(self.start[t + 1])) for t in terms]
        lists = [(a, b) for a, b in lists if b > a]
        seen = np.zeros(self.n_rows, bool)
        marks = [np.zeros(b - a, bool) for a, b in lists]
        best = [0] * len(lists)     # positions from the first on that are all seen
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step, looked_up = 0, FIRST_READ, 0
        while any(n < b - a for n, (a, b) in zip(best, lists)):
            # sorted access
            new = np.concatenate([self.row[self.falling[min(b, a + at):min(b, a + at + step)]] for a, b in lists])
            new = np.unique(new[~seen[new]])
            seen[new] = True
            looked_up += len(new)
            # direct access
            total = np.zeros(len(new), np.int64)
            for (a, b), mark in zip(lists, marks):
                i = a + np.searchsorted(self.row[a:b], new)
                held = self.row[np.minimum(i, b - 1)] == new
                i = i[held]
                total[held] += self.impact[i]
                mark[self.place[i]] = True
            bound = 0
            for j, ((a, b), mark) in enumerate(zip(lists, marks)):
                ahead = mark[best[j]:]
                best[j] += len(ahead) if ahead.all() else int(ahead.argmin())
                if best[j] < b - a:
                    bound += int(self.impact[self.falling[a + best[j] - 1]])
            good = total >= floor
            rows, scores = np.concatenate([rows, new[good]]), np.concatenate([scores, total[good]])
            first = np.lexsort((rows, -scores))[:k]
            rows, scores = rows[first], scores[first]
            if bound < (max(floor, int(scores[-1])) if len(rows) == k else floor):
                break
            at, step = at + step, max(step, at + step)
        return rows, scores, looked_up


def _item_blocks(spark: SparkSession, items: DataFrame) -> DataFrame:
    """Rows (block: pickled list of (item id, terms)) of at most ITEM_BYTES
    of terms, or one item."""
    texts = items.select(F.col("item_id"), F.col("text").cast("binary").alias("text")).where("text is not null")
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    id_type = texts.schema["item_id"].dataType.simpleString()

    def terms(batches):
        for batch in batches:
            found = [sorted(set(folded_words(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])

    def blocks(batches):
        held, n = [], 0
        for batch in batches:
            for name, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n and n + sum(map(len, found)) > ITEM_BYTES:
                    yield pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(held)], pa.binary())})
                    held, n = [], 0
                held.append((name, found))
                n += sum(map(len, found))
        if held:
            yield pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(held)], pa.binary())})

    merged = (texts.mapInArrow(terms, f"item_id {id_type}, terms array<binary>").where(F.size("terms") > 0).groupBy("item_id")
              .agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")))
    return staged(spark, merged.coalesce(-(-size // ITEM_BYTES) or 1).mapInArrow(blocks, "block binary"), "items")


def _described(docs: DataFrame, known) -> DataFrame:
    """(doc_id, n, terms, tfs) of the documents with a term: number of terms,
    query terms among them (numbers) and how often."""

    def run(batches):
        number = known.value
        for batch in batches:
            out = ([], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                words = folded_words(text.as_py())
                if words:
                    held = [(number[w], n) for w, n in Counter(words).items() if w in number]
                    for column, value in zip(out, (doc_id, len(words), [t for t, _ in held], [n for _, n in held])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int32())),
                                              pa.array(out[3], pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _level_of_shards(rows: DataFrame, plan, k: int) -> DataFrame:
    """(item, doc_id, score) of the ``k`` best of every shard of ``rows``."""

    def run(batches):
        items, weight, n_docs, n_terms, floor = plan.value

        def searched(held):
            doc_id = np.concatenate([np.asarray(b.column(0).fill_null(np.iinfo(np.int64).max)) for b in held])
            known = np.concatenate([np.asarray(b.column(0).is_valid().cast(pa.int8())) for b in held])
            n, terms, tfs = (np.concatenate([np.asarray(f(b)) for b in held]).astype(np.int64) for f in (
                lambda b: b.column(1), lambda b: b.column(2).flatten(), lambda b: b.column(3).flatten()))
            of = np.concatenate([np.asarray(b.column(2).value_lengths()) for b in held])
            order = np.lexsort((-known, doc_id))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            m = 100 - 50 + 50 * n * n_docs // n_terms
            row = np.repeat(np.arange(len(n)), of)
            impact = weight[terms] * (1_000_000_000 * tfs // (1000 * tfs + 20 * m[row]))
            some = impact > 0
            shard = Shard(len(n), rank[row[some]], terms[some], impact[some], len(weight))
            out = ([], [], [])
            for item, its in enumerate(items):
                rows, scores, _ = shard.search(its, k, int(floor[item]))
                out[0].append(np.full(len(rows), item, np.int32))
                out[1].append(order[rows])
                out[2].append(scores)
            item, at, score = map(np.concatenate, out)
            return pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc_id[at], mask=known[at] == 0), pa.array(score)], names=["item", "doc_id", "score"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column(2).flatten()) + batch.num_rows
            if size > SHARD_POSTINGS:
                yield searched(held)
                held, size = [], 0
        if size:
            yield searched(held)

    return rows.select("doc_id", "n", "terms", "tfs").mapInArrow(run, "item int, doc_id long, score long")


def _search(spark: SparkSession, docs: DataFrame, items: list, k: int) -> DataFrame:
    """(item, rank, doc_id, score) for items (lists of terms), numbered."""
    number = {w: t for t, w in enumerate(sorted({w for its in items for w in its}))}
    known = spark.sparkContext.broadcast(number)
    h = F.xxhash64("doc_id", "n", F.rand(7))  # spreads repeated rows too; any deal gives the same result
    level = F.least(F.lit(9), (F.length(F.regexp_extract(F.hex(h), "0*$", 0)))).cast("int")
    rows = staged(spark, _described(docs, known).withColumn("level", level), "described", "level")
    counts = rows.groupBy("level").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("terms")).collect()  # ten rows at most
    n_docs, n_terms = sum(r.rows for r in counts), sum(r.terms for r in counts)
    weight = np.zeros(len(number), np.int64)
    for r in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toLocalIterator():
        weight[r.t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
    terms = [[number[w] for w in its if weight[number[w]]] for its in items]
    floor = np.ones(len(items), np.int64)
    found, above, top = None, 10, 10
    while above:
        # the next levels that together have LEVEL_ROWS, or one
        above, size = top, 0
        while above and size < LEVEL_ROWS:
            above -= 1
            size += sum(r.rows for r in counts if r.level == above)
        plan = spark.sparkContext.broadcast((terms, weight, n_docs, max(1, n_terms), floor))
        more = _level_of_shards(rows.where(F.col("level").between(above, top - 1)), plan, k)
        found = staged(spark, _best(more if found is None else more.union(found.select("item", "doc_id", "score")), k), "best")
        for r in found.where(F.col("rank") == k).select("item", "score").collect():  # one an item
            floor[r.item] = r.score
        top = above
    return found


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` rows of ``docs`` (doc_id,
    text) of the highest scores above 0 for every item (item_id, text).

    Terms are runs of digits, letters and characters beyond ASCII, A-Z as
    a-z.  Null, empty and wordless texts have none: they are neither counted
    nor found, and such items find nothing; rows of one item_id (null
    included) are one item with the terms of all; equal scores rank by
    doc_id, rows without id last, repeated rows each count and rank; empty
    tables give no rows; other columns are not read."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    id_type = items.schema["item_id"].dataType
    out = spark.createDataFrame([], f"item_id {id_type.simpleString()}, rank int, doc_id long, score long")
    for block in _item_blocks(spark, items).toLocalIterator():
        its = pickle.loads(bytes(block.block))
        names = spark.createDataFrame([(n, name) for n, (name, _) in enumerate(its)], f"item int, item_id {id_type.simpleString()}")
        found = _search(spark, docs, [terms for _, terms in its], k)
        out = out.union(found.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
    return out
