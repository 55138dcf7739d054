"""N-gram Jaccard join: classes of texts whose sets of word 5-grams have a
similarity of at least 0.75, exactly.

Texts with the same words form a class; joins work on classes.  By the
prefix principle, two similar sets share a shingle among the first quarter
(and one) of their shingles in any common order; the order used puts
shingles found frequent first-hand last.  Classes that share such a shingle
are compared within size-banded tiles: hashed bitmaps (two bits a shingle)
bound the overlap from above, and pairs that pass are settled by intersecting
the exact sorted arrays.

Only links between different components matter, so the work goes in rounds:
(1) every class against the first class of each shingle, (2) every class
against its most promising partner in another component, (3) all pairs still
in different components that pass the bound, each found in one tile only, of
the classes that had a partner there in round 2.
No round writes more than a row per shared shingle, but for pairs of the last
round, which links have not joined and bounds cannot rule out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import most_frequent, small_batches, staged
from .graph import components, runs_of

WORDS = 5
PERCENT = 75
FREQUENT = 1 << 20      # shingles the order knows to be frequent (any number is right)
SALTS = 64              # tasks over which a frequent shingle is spread
BLOCK = 512
PROMISING_ROUNDS = 1
BROADCAST_IDS = 500_000  # ids (8 bytes each) sent to all tasks; more are joined by a shuffle
_COUNTED_AT_ONCE = 1 << 20
_TEXTS_IN_BATCH = 2_000
_ENTRIES_IN_BATCH = 1 << 17
_PAIRS_IN_BATCH = 500    # rows with a bitmap or a whole text that an Arrow batch holds
_PARTNERS = 256         # classes that one task run compares with one class
_MULTIPLIERS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD]


_MIX = [np.uint64(x) for x in _MULTIPLIERS]
_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
# a value per byte, A-Z as a-z, 0 for blanks
_VALUES = np.array([0 if _BLANK[b] else xxhash.xxh64_intdigest(bytes([b]).lower()) | 1 for b in range(256)], np.uint64)
_PIECE = 1 << 12        # bytes hashed at a time, unless a word is longer; its powers go along with every task


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n - 1 of an odd number and those of its inverse, modulo 2 ** 64."""
    inverse = pow(_MULTIPLIERS[0], -1, 1 << 64)
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full(n - 1, x, np.uint64)]) for x in (_MULTIPLIERS[0], inverse))


_POWERS = _powers(_PIECE)


def _hashed(raw: np.ndarray) -> np.ndarray:
    """The hashes of the words of ``raw``: polynomials of their bytes, as
    differences of one running sum, mixed."""
    blank = np.ones(len(raw) + 2, bool)
    blank[1:-1] = _BLANK[raw]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _POWERS if len(raw) <= _PIECE else _powers(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * up[:len(raw)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    h ^= h >> np.uint64(32)
    h *= _MIX[4]
    h ^= h >> np.uint64(29)
    h *= _MIX[1]
    return h ^ (h >> np.uint64(32))


def word_hashes(text: str | bytes | None) -> np.ndarray:
    """64-bit hashes of the lower-cased words, in order."""
    raw = np.frombuffer((text or "").encode() if not isinstance(text, bytes) else text, np.uint8)
    parts, at = [], 0
    while at < len(raw):
        end = at + _PIECE
        if end < len(raw):  # a piece ends at a blank
            blanks = np.flatnonzero(_BLANK[raw[at:end]])
            if len(blanks):
                end = at + int(blanks[-1]) + 1
            else:
                later = _BLANK[raw[end:]]
                end = end + int(later.argmax()) + 1 if later.any() else len(raw)
        parts.append(_hashed(raw[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles (of the whole
    sequence, if shorter; none without words), from :func:`word_hashes`."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh64_intdigest(words.tobytes(), seed=len(words))], np.uint64)
    n = len(words) - WORDS + 1
    h = words[:n] * _MIX[0]
    for k in range(1, WORDS):
        h = (h ^ (h >> np.uint64(29))) * _MIX[4] + words[k:n + k] * _MIX[k - 1]
    h ^= h >> np.uint64(32)
    h *= _MIX[0]
    h ^= h >> np.uint64(29)
    h.sort()
    return h[np.r_[True, h[1:] != h[:-1]]]  # np.unique takes several times as long


def bitmap(shingle_set: np.ndarray) -> bytes:
    """A power of two of bits, at least 64 and twice the set's size;
    folding halves onto each other gives that of half the width."""
    width = 64
    while width < 2 * len(shingle_set):
        width *= 2
    bits = np.zeros(width, np.uint8)
    bits[(shingle_set & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, all of the smallest width."""
    width = min(map(len, bits))
    rows = []
    for b in bits:
        x = np.frombuffer(b, np.uint64)
        while len(x) * 8 > width:
            x = x[:len(x) // 2] | x[len(x) // 2:]
        rows.append(x)
    return np.stack(rows)


def may_link(overlap, a, b):
    """Whether sets of sizes a and b with (at most) this overlap are similar."""
    return 100 * overlap >= PERCENT * (a + b - overlap)


def most_overlap(bits_a, bits_b, size_a, size_b) -> np.ndarray:
    """Upper bounds of the overlaps of all pairs: a bit of one bitmap that
    the other lacks is at least one shingle that the other lacks."""
    own_a, own_b = np.bitwise_count(bits_a).sum(1, dtype=np.int64), np.bitwise_count(bits_b).sum(1, dtype=np.int64)
    out = np.empty((len(bits_a), len(bits_b)), np.int64)
    step = max(1, (1 << 20) // max(1, bits_b.size))
    for at in range(0, len(bits_a), step):
        part = slice(at, at + step)
        common = np.bitwise_count(bits_a[part, None, :] & bits_b[None, :, :]).sum(2, dtype=np.int64)
        out[part] = np.minimum(size_a[part, None] - own_a[part, None] + common, size_b[None, :] - own_b[None, :] + common)
    return out


def class_key(words: np.ndarray) -> int:
    h = xxhash.xxh3_64_intdigest(words.tobytes())
    return h - (1 << 64) if h >> 63 else h


def _describe(docs: DataFrame) -> DataFrame:
    """kind 0: every document's class and set size, and the class's bitmap
    once a task; kind 1: shingles that some documents of a task share."""

    def run(batches):
        seen, held, size = set(), [], 0

        def shared():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            values, n = values[n > 1].view(np.int64), n[n > 1]
            none = pa.nulls(len(values), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(np.ones(len(values), np.int32)), none, pa.array(values), pa.array(n),
                                               pa.nulls(len(values), pa.binary())], names=["kind", "doc_id", "key", "size", "bits"])

        for batch in batches:
            keys, sizes, bits = [], [], []
            for text in batch.column(1):
                words = word_hashes(text.as_py())
                keys.append(class_key(words))
                s = shingles(words)
                sizes.append(len(s))
                first = len(s) and keys[-1] not in seen
                bits.append(bitmap(s) if first else None)
                if first:
                    seen.add(keys[-1])
                    held.append(s)
                    size += len(s)
                if size > _COUNTED_AT_ONCE:
                    yield shared()
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(keys), np.int32)), batch.column(0), pa.array(keys, pa.int64()),
                                              pa.array(sizes, pa.int64()), pa.array(bits, pa.binary())],
                                             names=["kind", "doc_id", "key", "size", "bits"])
        if held:
            yield shared()

    return docs.mapInArrow(run, "kind int, doc_id long, key long, size long, bits binary")


def _prefixes(docs: DataFrame, frequent) -> DataFrame:
    """(shingle, salt, class, size) of the prefix of every class, once a
    task.  ``frequent`` (broadcast): shingles by value, and their places in
    the order of their counts."""

    def run(batches):
        ordered, by_value = frequent.value
        seen = set()
        parts, salts, keys, sizes, entries = [], [], [], [], 0

        def joined():
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.concatenate(salts)), pa.array(np.concatenate(keys)),
                 pa.array(np.concatenate(sizes))], names=["shingle", "salt", "class", "size"])

        for batch in batches:
            for text in batch.column(1):
                words = word_hashes(text.as_py())
                key = class_key(words)
                if not len(words) or key in seen:
                    continue
                seen.add(key)
                s = shingles(words)
                n = len(s)
                length = n - (PERCENT * n + 99) // 100 + 1
                place = np.full(n, -1)
                if len(ordered):
                    at = np.minimum(np.searchsorted(ordered, s), len(ordered) - 1)
                    place = np.where(ordered[at] == s, by_value[at], -1)
                rare = s[place < 0][:length]
                often = s[place >= 0][np.argsort(place[place >= 0])][:length - len(rare)]
                parts += [rare, often]
                salts.append(np.repeat(np.array([0, 1 + key % SALTS], np.int32), [len(rare), len(often)]))
                keys.append(np.full(length, key, np.int64))
                sizes.append(np.full(length, n, np.int64))
                entries += length
                if entries >= _ENTRIES_IN_BATCH:
                    yield joined()
                    parts, salts, keys, sizes, entries = [], [], [], [], 0
        if entries:
            yield joined()

    return docs.mapInArrow(run, "shingle long, salt int, class long, size long")


def _beside(pairs: DataFrame, table: DataFrame, what: list[str]) -> DataFrame:
    """The pairs (a, b) as runs of one key ``run``: first a row with the
    columns ``what`` of b (partner null), then a row with those of a for
    every a.  Partners of one b beyond _PARTNERS make several runs."""
    runs = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / _PARTNERS).cast("int").alias("runs"))
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heads = runs.select(F.col("b").alias("class"), "b", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("k"), F.lit(None).cast("long").alias("a"))
    rows = pairs.join(runs, "b").select(F.col("a").alias("class"), "b", F.pmod(F.xxhash64("a"), F.col("runs")).cast("int").alias("k"), "a")
    return (heads.union(rows).join(table, "class").select("b", "k", "a", *what).withColumn("run", F.xxhash64("b", "k"))
            .repartition(parts, "run").sortWithinPartitions("run", F.col("a").isNotNull()))


def _bounded(spark: SparkSession, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bitmaps allow a link."""

    def run(batches):
        b = size_b = bits_b = None
        for batch in batches:
            keep = []
            for place, (x, y, size, bits) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("b", "a", "size", "bits")))):
                if y is None:
                    b, size_b, bits_b = x, np.array([size]), bits
                    continue
                assert b == x
                two = folded([bits, bits_b])
                if may_link(int(most_overlap(two[:1], two[1:], np.array([size]), size_b)[0, 0]), size, int(size_b[0])):
                    keep.append(place)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    with small_batches(spark, _PAIRS_IN_BATCH):
        return staged(spark, _beside(pairs, classes, ["size", "bits"]).mapInArrow(run, "a long, b long"), "pairs")


def _semi(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    ids = ids.select(F.col("doc_id").alias("_wanted"))
    if n <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_wanted")), "left_semi")


def _settle(spark: SparkSession, docs: DataFrame, pairs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(a, b, linked) for the class pairs, by intersecting their sets."""
    wanted = staged(spark, pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct().join(firsts, "class"), "wanted")
    n = wanted.count()

    def canonical(batches):
        for batch in batches:
            words = [b" ".join(words_of(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array([class_key(word_hashes(w)) for w in words], pa.int64()), pa.array(words, pa.binary())],
                                             names=["class", "words"])

    # not staged: their one shuffle serves the join with the pairs too
    texts = (_semi(docs, wanted, n).mapInArrow(canonical, "class long, words binary")
             .join(wanted.select("class"), "class", "left_semi").groupBy("class").agg(F.first("words").alias("words")))

    def run(batches):
        b = set_b = None
        for batch in batches:
            found = ([], [], [])
            for x, y, words in zip(batch.column("b").to_pylist(), batch.column("a").to_pylist(), batch.column("words")):
                mine = shingles(word_hashes(words.as_py()))
                if y is None:
                    b, set_b = x, mine
                    continue
                assert b == x
                for column, value in zip(found, (y, x, may_link(len(np.intersect1d(mine, set_b, assume_unique=True)), len(mine), len(set_b)))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.bool_())],
                                             names=["a", "b", "linked"])

    with small_batches(spark, _PAIRS_IN_BATCH):
        return staged(spark, _beside(pairs, texts, ["words"]).mapInArrow(run, "a long, b long, linked boolean"), "settled")


def _tiles(members: DataFrame) -> DataFrame:
    """``members`` (shingle, class, size, ...) dealt to size-banded tiles:
    two classes of similar sizes are at most one band apart, bands are cut
    into hashed blocks, and a tile is a pair of blocks of one shingle."""
    members = members.withColumn("band", F.floor(F.log(F.col("size")) / F.log(F.lit(100 / PERCENT)) + 1e-9).cast("int"))
    blocks = (members.groupBy("shingle", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n"))
              .groupBy("shingle").agg(F.map_from_entries(F.collect_list(F.struct("band", "n"))).alias("blocks")))  # some dozens of bands
    members = members.join(blocks, "shingle").withColumn("block", F.pmod(F.xxhash64("class", "shingle"), F.col("blocks")[F.col("band")]).cast("int"))
    tile = F.expr("""flatten(array(
        transform(sequence(0, blocks[band] - 1), j -> struct(band as low, 0 as up, least(block, j) as i, greatest(block, j) as j, block > j as right)),
        if(try_element_at(blocks, band + 1) is null, array(), transform(sequence(0, try_element_at(blocks, band + 1) - 1),
           j -> struct(band as low, 1 as up, block as i, j as j, false as right))),
        if(try_element_at(blocks, band - 1) is null, array(), transform(sequence(0, try_element_at(blocks, band - 1) - 1),
           i -> struct(band - 1 as low, 1 as up, i as i, block as j, true as right)))))""")
    return (members.withColumn("t", F.explode(tile))
            .withColumn("tile", F.xxhash64("shingle", "t.low", "t.up", "t.i", "t.j"))
            .withColumn("square", (F.col("t.up") == 0) & (F.col("t.i") == F.col("t.j"))).withColumn("right", F.col("t.right"))
            .drop("t", "blocks", "block", "band"))


def _few(ids: DataFrame) -> DataFrame:
    """``ids`` (staged), sent to all tasks if they are at most BROADCAST_IDS."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _mixed(spark: SparkSession, shared: DataFrame, found: DataFrame, least: int) -> DataFrame:
    """(shingle, class, size, component) of the shingles of several
    components and ``least`` classes; other shingles cannot have them later
    either."""
    members = shared.select("shingle", "class", "size").join(found, F.col("class") == F.col("node"), "left").select("shingle", "class", "size", F.coalesce("component", "class").alias("component"))
    members = staged(spark, members, "members")
    # of those that the same classes share, as a common passage has many, the first
    mixed = (members.groupBy("shingle").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("class")).alias("s"), F.bit_xor(F.xxhash64("class", F.lit("again"))).alias("t"))
        .where(f"x <> y and n >= {least}").groupBy("n", "s", "t").agg(F.min("shingle").alias("shingle")).select("shingle"))
    return staged(spark, members.join(_few(staged(spark, mixed, "mixed")), "shingle", "left_semi"), "members")


def _candidates(spark: SparkSession, members: DataFrame, classes: DataFrame, tried: DataFrame, every: bool) -> DataFrame:
    """(a, b, bound) of pairs in different components that bitmaps allow and
    that have not been tried, with the tile's shingle and the size of a: for
    every class that has any the most promising of a tile, or with ``every``
    all of them, in the tile of their first shared shingle."""
    tried = tried.groupBy("a").agg(F.collect_list("b").alias("tried")).withColumnRenamed("a", "class")
    wanted = staged(spark, members.select("class").distinct(), "wanted")
    more = classes.select("class", "bits").join(_few(wanted), "class", "left_semi").join(tried, "class", "left")
    if every:  # the shared shingles of a class: at most a prefix of its text
        more = more.join(members.groupBy("class").agg(F.sort_array(F.collect_list("shingle")).alias("shingles")), "class")
    # bitmaps go only to tiles with something to compare
    placed = staged(spark, _tiles(members), "tiles")
    useful = (placed.groupBy("tile").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("square").alias("square"),
                                         F.min("right").alias("l"), F.max("right").alias("r"))
              .where("x <> y and (square or (not l and r))").select("tile"))
    placed = placed.join(_few(staged(spark, useful, "useful")), "tile", "left_semi")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiles = placed.join(more, "class").repartition(parts, "tile").sortWithinPartitions("tile")

    def run(batches):
        for _, t in runs_of(batches, "tile"):
            component = t.column("component").to_numpy()
            if (component == component[0]).all():
                continue
            square = t.column("square")[0].as_py()
            right = t.column("right").to_numpy(zero_copy_only=False).astype(bool)
            left_rows, right_rows = (np.arange(t.num_rows),) * 2 if square else (np.flatnonzero(~right), np.flatnonzero(right))
            if not len(left_rows) or not len(right_rows):
                continue
            key, size = t.column("class").to_numpy(), t.column("size").to_numpy()
            # before any bitmap: different components, and sizes that could link
            apart = component[left_rows][:, None] != component[right_rows][None, :]
            smaller, larger = (f(size[left_rows][:, None], size[right_rows][None, :]) for f in (np.minimum, np.maximum))
            apart &= 100 * smaller >= PERCENT * larger
            if not apart.any():
                continue
            bits = folded(t.column("bits").to_pylist())
            done = [set(x or ()) for x in t.column("tried").to_pylist()]
            bound = most_overlap(bits[left_rows], bits[right_rows], size[left_rows], size[right_rows])
            ok = may_link(bound, size[left_rows][:, None], size[right_rows][None, :]) & apart
            i, j = np.nonzero(np.triu(ok, 1) if square else ok)
            a, b, likely = left_rows[i], right_rows[j], bound[i, j] / (size[left_rows][i] + size[right_rows][j])
            some = np.array([key[y] not in done[x] and key[x] not in done[y] for x, y in zip(a.tolist(), b.tolist())], bool)
            a, b, likely = a[some], b[some], likely[some]
            shingle = t.column("shingle")[0].as_py()
            if every:
                own = t.column("shingles").to_pylist()
                first = np.array([np.intersect1d(own[x], own[y], assume_unique=True)[0] == shingle for x, y in zip(a.tolist(), b.tolist())], bool)
                a, b, likely = a[first], b[first], likely[first]
            else:  # the best partner of each class
                who, partner, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([likely, likely])
                order = np.lexsort((key[partner], -value, who))
                who, partner, value = who[order], partner[order], value[order]
                lead = np.ones(len(who), bool)
                lead[1:] = who[1:] != who[:-1]
                a, b, likely = who[lead], partner[lead], value[lead]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(key[a]), pa.array(key[b]), pa.array(likely), pa.array(np.full(len(a), shingle)), pa.array(size[a])],
                                                 names=["a", "b", "bound", "shingle", "size"])

    return tiles.mapInArrow(run, "a long, b long, bound double, shingle long, size long")


def near_texts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``
    (doc_id, text): the size of the text's set and the smallest doc_id
    reachable by links, its own included.

    Null and empty texts, and those without words, have no set and link with
    nothing; texts of equal words link; repeated rows stay and link as equal
    texts; rows without an id count as links but never name a component, so
    theirs is null where no other has an id; an empty table gives no rows;
    other columns are not read.  Classes and shingles go by 64-bit hashes."""
    return _near(spark, docs).select("doc_id", "n_shingles", "component_id")


def _near(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """:func:`near_texts` with the class of every row, and that of the row
    that names its component: the smallest (doc_id, class)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with small_batches(spark, _TEXTS_IN_BATCH):
        described = staged(spark, _describe(docs), "described")
    common = staged(spark, described.where("kind = 1").groupBy("key").agg(F.sum("size").alias("n")), "common")
    common = most_frequent(common, "n", FREQUENT).toArrow()  # at most FREQUENT rows
    key, n = common.column("key").to_numpy(), common.column("n").to_numpy()
    frequent = key[np.lexsort((key, n))].view(np.uint64)
    by_value = np.argsort(frequent)
    frequent = spark.sparkContext.broadcast((frequent[by_value], by_value.astype(np.int32)))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = (_prefixes(docs, frequent).repartition(parts, "shingle", "salt")
               .groupBy("shingle", "salt", "class").agg(F.max("size").alias("size")))
    together = Window.partitionBy("shingle", "salt")
    held = entries.withColumns({"n": F.count(F.lit(1)).over(together), "first": F.min(F.struct("class", "size")).over(together)})
    with small_batches(spark, _TEXTS_IN_BATCH):
        shared = staged(spark, held.where("n > 1 or salt > 0").select(
            "shingle", "class", "size", F.expr("salt > 0").alias("salted"), F.expr("n > 2 or salt > 0").alias("several"),
            F.col("first.class").alias("b"), F.col("first.size").alias("size_b")), "shared")

    one = described.where("kind = 0 and size > 0")
    firsts = staged(spark, one.groupBy(F.col("key").alias("class")).agg(F.min("doc_id").alias("doc_id")), "firsts")
    classes = staged(spark, one.where("bits is not null").select(F.col("key").alias("class"), "size", "bits")
                     .join(shared.select("class").distinct(), "class", "left_semi").groupBy("class").agg(F.first("size").alias("size"), F.first("bits").alias("bits")), "classes")

    # round 1: every class against the first class, for every shingle (a
    # frequent one: of its salt, and those against the first of all)
    firsts_of = shared.where("salted").groupBy("shingle", "b", "size_b").agg(F.lit(0).alias("x"))
    least_of = firsts_of.groupBy("shingle").agg(F.min(F.struct("b", "size_b")).alias("l"))
    pairs = shared.select("class", "size", "b", "size_b").union(firsts_of.join(least_of, "shingle").select("b", "size_b", "l.b", "l.size_b"))
    pairs = (pairs.where(F.col("class") != F.col("b"))
             .where(F.least("size", "size_b") * 100 >= F.greatest("size", "size_b") * PERCENT).select(F.col("class").alias("a"), "b").distinct())
    pairs = _bounded(spark, staged(spark, pairs, "pairs"), classes)
    settled = _settle(spark, docs, pairs, firsts)
    links, tried = settled.where("linked").select("a", "b"), settled.where("not linked").select("a", "b")
    found = components(spark, links)

    members = shared.where("several")
    for turn in range(PROMISING_ROUNDS + 1):
        every = turn == PROMISING_ROUNDS
        members = _mixed(spark, members, found, 2 if turn else 3)  # two classes alone have met in round 1
        pairs = staged(spark, _candidates(spark, members, classes, tried, every), "candidates")
        if not every:  # one partner a class; a class that has none in a tile has none there later, when components are fewer
            members = pairs.select("shingle", F.col("a").alias("class"), "size").distinct()
            pairs = pairs.groupBy("a").agg(F.max(F.struct("bound", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
        pairs = staged(spark, pairs.select("a", "b").distinct(), "pairs")
        if pairs.isEmpty():
            if not every:
                break  # no pair is left that the bitmaps allow
            continue
        settled = _settle(spark, docs, pairs, firsts)
        links = links.union(settled.where("linked").select("a", "b"))
        tried = tried.union(settled.where("not linked").select("a", "b"))
        found = components(spark, staged(spark, found.select(F.col("node").alias("a"), F.col("component").alias("b"))
                                         .union(settled.where("linked").select("a", "b")), "links"))

    root = staged(spark, firsts.join(found, F.col("class") == F.col("node"), "left")
                  .select("class", "doc_id", F.coalesce("component", "class").alias("root")), "roots")
    least = root.groupBy("root").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "class"))).alias("l"))
    least = staged(spark, least.select("root", F.col("l.doc_id").alias("component_id"), F.col("l.class").alias("component_class")), "least")
    named = staged(spark, root.join(least, "root").select("class", "component_id", "component_class"), "named")
    rows = described.where("kind = 0").select("doc_id", F.col("key").alias("class"), F.col("size").alias("n_shingles"))
    columns = ["doc_id", "class", "n_shingles", "component_id", "component_class"]
    alone = rows.where("n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "component_class": F.col("class")})
    return rows.where("n_shingles > 0").join(named, "class").select(*columns).union(alone.select(*columns))


def _with_class(rows: DataFrame) -> DataFrame:
    """``rows`` (id, row: struct with a text) plus the class of the text."""

    def run(batches):
        for batch in batches:
            keys = [class_key(word_hashes(t.as_py())) for t in batch.column(1).field("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=["id", "row", "class"])

    return rows.select("id", "row").mapInArrow(run, StructType([rows.schema["id"], rows.schema["row"], StructField("class", LongType())]))


def one_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns whatever their names, less near
    duplicates: of each component one row of the smallest (doc_id, class)
    stays, so that an id on several texts keeps those of other components.
    Null and empty texts, those without words and rows without an id all
    stay; repeated rows are near duplicates of each other, ties between them
    are any; an empty table gives no rows."""
    rows = staged(spark, _near(spark, docs), "near")
    repeated = rows.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("most")).where("n > 1 and most > 0")
    repeated = staged(spark, repeated.select(F.col("doc_id").alias("again")), "repeated")
    several = not repeated.isEmpty()
    leaving = rows.where("n_shingles > 0 and doc_id is not null and (doc_id <> component_id or class <> component_class)")
    one = leaving.join(repeated, F.col("doc_id") == F.col("again"), "left_anti") if several else leaving  # an id of one row names it
    dropped = staged(spark, one.select(F.col("doc_id").alias("gone")).distinct(), "dropped")
    gone = F.broadcast(dropped) if dropped.count() <= BROADCAST_IDS else dropped
    nested = docs.select(F.col("doc_id").cast("long").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = nested.join(gone, F.col("id") == F.col("gone"), "left_anti")
    if several:
        pairs = (leaving.join(repeated, F.col("doc_id") == F.col("again"), "left_semi")
                 .select(F.col("doc_id").alias("gone"), F.col("class").alias("gone_class")).distinct())
        more = staged(spark, _with_class(nested.join(repeated, F.col("id") == F.col("again"), "left_semi"))
                      .join(pairs, (F.col("id") == F.col("gone")) & (F.col("class") == F.col("gone_class")), "left_anti"), "several")
        wordless = F.col("class") == class_key(word_hashes(None))
        first = more.where(~wordless).groupBy("id", "class").agg(F.min_by("row", F.col("row.text")).alias("row"))
        kept = (kept.join(repeated, F.col("id") == F.col("again"), "left_anti").select("row")
                .unionByName(more.where(wordless).select("row")).unionByName(first.select("row")))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
