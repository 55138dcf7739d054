"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest reference points (pivots) in order
of nearness.  Equal vectors are one entry of the index; it stands in the
inverted lists of the first ``LISTS`` of its pivots.  For the entries that
meet in a list, the shared ones among their first ``ORDER`` pivots are counted
through inverted lists of those, and only pairs that share enough are
verified by their exact cosine.  Long lists are cut into hashed blocks, and
each pair of blocks is one tile, so no list meets in one task; a tile gives
link counts and spanning links, never all pairs.  Vectors of each length have
an index of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged
from .graph import components, runs_of, spanning

PIVOT_BYTES = 32 << 20  # pivots follow the square root of the rows up to this size, that is sent to all tasks
MIN_PIVOTS = 64
PIVOTS_APART = 0.8      # pivots more alike than this would make the order a matter of noise
LISTS = 4
ORDER = 8
MIN_SHARED = 2
BLOCK = 1024
_VERIFIED_AT_ONCE = 1 << 14


def unit_of(x: np.ndarray) -> np.ndarray | None:
    """``x`` at length 1; None if it is zero or not all finite."""
    size = np.abs(x).max()
    if not np.isfinite(size) or size == 0:
        return None
    x = x / size
    return x / np.sqrt(x @ x)


def choose_pivots(entries: DataFrame, dim: int, n: int) -> np.ndarray:
    """About sqrt(n) of the ``entries`` (vector), 64 at least and PIVOT_BYTES
    at most: first in the order of a hash, no two with a cosine above
    ``PIVOTS_APART``.  Twice as many reach the driver."""
    wanted = min(max(1, PIVOT_BYTES // (8 * dim)), max(MIN_PIVOTS, math.isqrt(n)))
    sample = entries.orderBy(F.xxhash64("key", F.lit("pivots")), "key").limit(2 * wanted).select("vector").collect()
    pivots, found = np.empty((min(wanted, len(sample)), dim)), 0
    for r in sample:
        x = np.frombuffer(r.vector, np.float64)
        if found < wanted and (not found or (pivots[:found] @ x).max() <= PIVOTS_APART):
            pivots[found] = x
            found += 1
    return pivots[:found]


def sharing(left: np.ndarray, right: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows that share ``least`` values or more, counted
    through the inverted lists of ``right``; a row's values are distinct."""
    order = np.argsort(right, axis=None, kind="stable")
    values, rows = right.ravel()[order], order // right.shape[1]
    first, behind = (np.searchsorted(values, left.ravel(), side) for side in ("left", "right"))
    n = behind - first
    at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    counts = np.bincount(np.repeat(np.arange(n.size) // left.shape[1], n) * len(right) + rows[at], minlength=len(left) * len(right))
    return np.divmod(np.flatnonzero(counts >= least), len(right))


def _links(spark: SparkSession, entries: DataFrame, dim: int, n: int, least: float) -> DataFrame:
    """(rep, n, root): link counts (copies counted) and spanning links of the
    ``entries`` (key, rep, copies, vector) of one length."""
    pivots = choose_pivots(entries, dim, n)
    held = spark.sparkContext.broadcast(pivots)
    lists, order = min(LISTS, len(pivots)), min(ORDER, len(pivots))
    shared_least = min(MIN_SHARED, order)

    def describe(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.float64).reshape(-1, dim)
            near = np.empty((len(x), order), np.int32)
            for at in range(0, len(x), 1024):
                likeness = x[at:at + 1024] @ held.value.T
                near[at:at + 1024] = np.argsort(-likeness, axis=1, kind="stable")[:, :order]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("copies"), batch.column("vector"), pa.array([v.tobytes() for v in near], pa.binary()),
                 pa.array(near[:, :lists].tolist(), pa.list_(pa.int32()))], names=["rep", "copies", "vector", "near", "lists"])

    described = staged(spark, entries.select("rep", "copies", "vector")
                       .mapInArrow(describe, "rep long, copies long, vector binary, near binary, lists array<int>"), "described")
    listed = described.select("rep", F.explode("lists").alias("pivot"))
    sizes = listed.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    in_list = (described.select("*", F.explode("lists").alias("pivot")).drop("lists")
               .join(F.broadcast(sizes), "pivot")  # at most one row a pivot
               .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
    tiles = (in_list.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))
             .select(F.xxhash64("pivot", "first", "second").alias("tile"),
                     (F.col("block") != F.col("first")).alias("right"), (F.col("first") == F.col("second")).alias("square"),
                     "pivot", "rep", "copies", "vector", "near"))

    def link(batches):
        none = np.iinfo(np.int32).max
        for _, t in runs_of(batches, "tile"):
            ids, copies = t.column("rep").to_numpy(), t.column("copies").to_numpy()
            near = np.frombuffer(b"".join(t.column("near").to_pylist()), np.int32).reshape(len(ids), order)
            pivot, square = t.column("pivot")[0].as_py(), t.column("square")[0].as_py()
            right = t.column("right").to_numpy(zero_copy_only=False).astype(bool)
            left_rows, right_rows = (np.arange(len(ids)),) * 2 if square else (np.flatnonzero(~right), np.flatnonzero(right))
            if not len(left_rows) or not len(right_rows):
                continue
            x = np.frombuffer(b"".join(t.column("vector").to_pylist()), np.float64).reshape(len(ids), -1)
            found_a, found_b = [ids[:0]], [ids[:0]]
            for at in range(0, len(left_rows), 256):
                some = left_rows[at:at + 256]
                i, j = sharing(near[some], near[right_rows], shared_least)
                a, b = some[i], right_rows[j]
                if square:
                    a, b = a[a < b], b[a < b]
                for start in range(0, len(a), _VERIFIED_AT_ONCE):
                    p, q = a[start:start + _VERIFIED_AT_ONCE], b[start:start + _VERIFIED_AT_ONCE]
                    # the first list in which the two meet is the one that counts them
                    met = (near[p][:, :lists, None] == near[q][:, None, :lists]).any(2)
                    p, q = (side[np.where(met, near[p][:, :lists], none).min(1, initial=none) == pivot] for side in (p, q))
                    ok = np.einsum("ij,ij->i", x[p], x[q]) >= least
                    found_a.append(p[ok])
                    found_b.append(q[ok])
            a, b = np.concatenate(found_a), np.concatenate(found_b)
            if len(a):
                n = (np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))).astype(np.int64)
                root = spanning(len(ids), a, b)
                linked = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(n[linked]), pa.array(ids[root[linked]])],
                                                 names=["rep", "n", "root"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return staged(spark, tiles.repartition(parts, "tile").sortWithinPartitions("tile")
                  .mapInArrow(link, "rep long, n long, root long"), "links")


def near_vectors(spark: SparkSession, vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``
    (vec_id, embedding: array of float or double).

    Links: cosine >= ``least`` in double precision, among pairs of one length
    that the index retrieves; equal vectors always link.  Rows with a null
    id, and vectors that are null, empty, zero or not finite, link with
    nothing.  Exact repeats of a row are one vector; where an id has several
    different vectors, each row has the links and the component of its
    vector.  Empty table: no rows.  Other columns are not
    read.  Equal vectors are found by two 64-bit hashes."""
    def normal(batches):
        for batch in batches:
            dims, units = [None] * batch.num_rows, [None] * batch.num_rows
            for k, (i, v) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if i is not None and v and None not in v:
                    unit = unit_of(np.array(v, np.float64))
                    if unit is not None:
                        dims[k], units[k] = len(v), unit.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(units, pa.binary())], names=["vec_id", "dim", "vector"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(normal, "vec_id long, dim int, vector binary")
    rows = staged(spark, rows.withColumns({"key": F.xxhash64("vector"), "key2": F.xxhash64(F.lit("again"), "vector")}), "vectors")
    once = rows.where("vector is not null").groupBy("dim", "key", "key2", "vec_id").agg(F.any_value("vector").alias("vector"))
    entries = staged(spark, once.groupBy("dim", "key", "key2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                                                  F.any_value("vector").alias("vector")), "entries")
    links = spark.createDataFrame([], "rep long, n long, root long, dim int")
    for r in entries.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():  # a row per length
        if r.n > 1:
            links = links.union(_links(spark, entries.where(F.col("dim") == r.dim), r.dim, r.n, least).withColumn("dim", F.lit(r.dim)))
    counts = staged(spark, links.groupBy("dim", "rep").agg(F.sum("n").alias("n")), "counts")
    found = components(spark, links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = (entries.join(counts, ["dim", "rep"], "left").join(found, F.col("rep") == F.col("node"), "left")
             .select("dim", "key", "key2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component")))
    return (rows.select("vec_id", "dim", "key", "key2").join(named, ["dim", "key", "key2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
