"""Tables that a stream keeps between micro-batches.

:class:`SlotTable` holds rows in named slots.  What a batch writes goes to a
folder of its own (its generation), and a small manifest per batch names the
generations that hold each slot; writing the manifest is the commit.  A batch
that runs again starts from the manifest of the batches before it and writes
the same folders anew, so nothing is applied twice, and readers never see a
half-written batch.

* :class:`CompactedTable`: the newest row per key; slots are hash buckets, and
  a batch rewrites the buckets of its keys only.
* :class:`TimerWheel`: rows that wait for a time; slots are spans of time, the
  later the wider, so their number stays small however far the times lie.
* :class:`AtomicSinks`: several outputs of a batch, visible together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from topicflow.session import exists

LAST = (1 << 31) - 1    # above every batch id
SLOT = "__slot"


class SlotTable:
    """Rows of ``schema`` in named slots below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root, schema

    def _listed(self, path: str, prefix: str) -> list[str]:
        """What stands behind ``prefix`` in the names of the folders in ``path``."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(hadoop)] if fs.exists(hadoop) else []
        return [n[len(prefix):] for n in names if n.startswith(prefix)]

    def _delete(self, path: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)

    def manifest(self, before: int = LAST) -> dict[str, list[int]]:
        """Slot -> generations, as committed by the newest batch below
        ``before``.  Rows: a handful per slot in use, never per data row."""
        path = f"{self.root}/manifest"
        for batch in sorted((b for b in map(int, self._listed(path, "batch=")) if b < before), reverse=True):
            if exists(self.spark, f"{path}/batch={batch}/_SUCCESS"):
                out: dict[str, list[int]] = {}
                rows = self.spark.read.schema("slot string, generation int").parquet(f"{path}/batch={batch}")
                for r in rows.where("slot is not null").collect():
                    out.setdefault(r.slot, []).append(r.generation)
                return {slot: sorted(g) for slot, g in out.items()}
        return {}

    def read(self, slots: dict[str, list[int]]) -> DataFrame:
        paths = [f"{self.root}/data/generation={g}/{SLOT}={slot}" for slot, gs in slots.items() for g in gs]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame, batch_id: int) -> list[str]:
        """Write ``rows`` (with SLOT) as the batch's generation: a file a
        slot, more where one is large; returns the slots."""
        path = f"{self.root}/data/generation={batch_id}"
        names = [f.name for f in self.schema.fields]
        rows.select(*names, SLOT).hint("rebalance", F.col(SLOT)).write.mode("overwrite").partitionBy(SLOT).parquet(path)
        return sorted(self._listed(path, f"{SLOT}="))

    def commit(self, batch_id: int, manifest: dict[str, list[int]], before: dict[str, list[int]]) -> None:
        """Make ``manifest`` that of the batch, then delete generations and
        manifests that neither it nor ``before`` (which a retry of the batch
        starts from) needs."""
        rows = [(slot, g) for slot, gs in manifest.items() for g in gs] or [(None, None)]
        self.spark.createDataFrame(rows, "slot string, generation int").coalesce(1).write.mode("overwrite") \
            .parquet(f"{self.root}/manifest/batch={batch_id}")
        held = {(slot, g) for m in (manifest, before) for slot, gs in m.items() for g in gs}
        for g in map(int, self._listed(f"{self.root}/data", "generation=")):
            path = f"{self.root}/data/generation={g}"
            slots = self._listed(path, f"{SLOT}=") if g < batch_id else []
            gone = [s for s in slots if (s, g) not in held]
            if g < batch_id and len(gone) == len(slots):
                self._delete(path)
            else:
                for s in gone:
                    self._delete(f"{path}/{SLOT}={s}")
        for b in sorted(b for b in map(int, self._listed(f"{self.root}/manifest", "batch=")) if b < batch_id)[:-1]:
            self._delete(f"{self.root}/manifest/batch={b}")


class CompactedTable:
    """S2 / ST6: the newest row per key of a changelog stream.

    ``merge`` folds a micro-batch in: its rows are reduced to the newest per
    key (combined map-side), and only the hash buckets of those keys are read
    and written again.  Tombstones (all ``values`` null) stay in the table
    while an older row of their key may still come, ``keep_tombstones`` on
    the first order column (None: for ever), and are dropped when their
    bucket is rewritten after that."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, order: Sequence[str],
                 values: Sequence[str], buckets: int = 64, keep_tombstones: Callable[[Column, Column], Column] | None = None):
        self.table = SlotTable(spark, root, schema)
        self.key, self.order, self.values, self.buckets, self.keep = key, list(order), list(values), buckets, keep_tombstones

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("string")

    def _newest(self, rows: DataFrame) -> DataFrame:
        names = [f.name for f in self.table.schema.fields]
        return (rows.groupBy(self.key).agg(F.max_by(F.struct(*names), F.struct(*self.order)).alias("__l"))
                .select(*[F.col(f"__l.{n}").alias(n) for n in names]))

    def _alive(self) -> Column:
        alive = F.lit(False)
        for c in self.values:
            alive = alive | F.col(c).isNotNull()
        return alive

    def merge(self, batch: DataFrame, batch_id: int) -> list[str]:
        """Fold one micro-batch in; returns the buckets that it rewrote."""
        names = [f.name for f in self.table.schema.fields]
        new = self._newest(batch.where(F.col(self.key).isNotNull()).select(*names)).withColumn(SLOT, self._bucket()).persist()
        touched = [r[0] for r in new.select(SLOT).distinct().collect()]  # at most one a bucket
        manifest = before = self.table.manifest(batch_id)
        if touched:
            old = self.table.read({b: manifest[b] for b in touched if b in manifest})
            rows = self._newest(old.unionByName(new.drop(SLOT)))
            if self.keep is not None:
                newest = new.agg(F.max(self.order[0])).first()[0]
                rows = rows.where(self._alive() | self.keep(F.col(self.order[0]), F.lit(newest)))
            written = self.table.write(rows.withColumn(SLOT, self._bucket()), batch_id)
            manifest = {**{b: g for b, g in manifest.items() if b not in touched}, **{b: [batch_id] for b in written}}
        self.table.commit(batch_id, manifest, before)
        new.unpersist()
        return sorted(touched)

    def rows(self, before: int = LAST, of: DataFrame | None = None) -> DataFrame:
        """The table as the batches below ``before`` left it, without
        tombstones; with ``of``, only the buckets of its keys are read."""
        manifest = self.table.manifest(before)
        if of is not None:
            wanted = {r[0] for r in of.where(F.col(self.key).isNotNull()).select(self._bucket()).distinct().collect()}
            manifest = {b: g for b, g in manifest.items() if b in wanted}
        return self.table.read(manifest).where(self._alive())


class TimerWheel:
    """Rows that wait until a frontier reaches their time (a long, ``due``).

    Slots of level 0 span ``unit``, those of the next level ``RATIO`` times as
    much, and so on; a row lies in the finest level that still has it within
    ``RATIO`` slots of the frontier.  When the frontier enters a slot, the
    rows of it that stay go to finer ones; a slot that it has passed is
    dropped.  So there are at most RATIO + 1 slots a level, whatever the
    times, and a slot of more than ``MERGE`` generations is rewritten as one."""

    RATIO, LEVELS, MERGE = 16, 10, 8

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, due: str, unit: int):
        self.table, self.due, self.unit = SlotTable(spark, root, schema), due, unit

    def _span(self, level: int) -> int:
        return self.unit * self.RATIO ** level

    def _slot(self, frontier: int) -> Column:
        due, out = F.col(self.due), F.lit("far")  # "far": beyond the last time there is
        for level in reversed(range(self.LEVELS)):
            span = self._span(level)
            number = F.expr(f"(`{self.due}` - pmod(`{self.due}`, {span}L)) div {span}L")
            inside = due < F.lit(min((1 << 63) - 1, (frontier // span + self.RATIO) * span))
            out = F.when(inside, F.concat(F.lit(f"{level}_"), number.cast("string"))).otherwise(out)
        return out

    def _start(self, slot: str) -> int:
        if slot == "far":
            return (1 << 63) - 1
        level, number = map(int, slot.split("_"))
        return number * self._span(level)

    def turn(self, batch_id: int, frontier: int, new: DataFrame | None = None) -> DataFrame:
        """The rows (waiting and ``new``) due at or before ``frontier``; the
        others wait.  Frontiers must not fall from batch to batch."""
        manifest = before = self.table.manifest(batch_id)
        entered = {slot: gs for slot, gs in manifest.items() if self._start(slot) <= frontier}
        waiting = {slot: gs for slot, gs in manifest.items() if slot not in entered}
        rows = self.table.read(entered)
        if new is not None:
            rows = rows.unionByName(new.select(*self.table.schema.names))
        crowded = {slot: gs for slot, gs in waiting.items() if len(gs) >= self.MERGE}
        stay = rows.where(F.col(self.due) > frontier).unionByName(self.table.read(crowded))
        written = self.table.write(stay.withColumn(SLOT, self._slot(frontier)), batch_id)
        manifest = {slot: gs for slot, gs in waiting.items() if slot not in crowded}
        for slot in written:
            manifest[slot] = [*manifest.get(slot, []), batch_id]
        out = rows.where(F.col(self.due) <= frontier)
        self._commit = (batch_id, manifest, before)
        return out

    def commit(self) -> None:
        """To be called when what :meth:`turn` returned has been written."""
        self.table.commit(*self._commit)

    def rest(self, before: int = LAST) -> DataFrame:
        """All rows that wait, as the batches below ``before`` left them."""
        return self.table.read(self.table.manifest(before))


class Frontier:
    """How far a stream has come: a long per batch, in a one-row table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def get(self, before: int = LAST) -> int | None:
        """The largest value of the batches below ``before``."""
        if not exists(self.spark, self.path):
            return None
        return (self.spark.read.schema("frontier long, batch int").parquet(self.path).where(F.col("batch") < before)
                .agg(F.max("frontier")).first()[0])

    def last(self, before: int = LAST) -> int | None:
        """The newest of the batches below ``before``."""
        if not exists(self.spark, self.path):
            return None
        return (self.spark.read.schema("frontier long, batch int").parquet(self.path).where(F.col("batch") < before)
                .agg(F.max("batch")).first()[0])

    def put(self, batch_id: int, value: int) -> None:
        (self.spark.createDataFrame([(value,)], "frontier long").coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/batch={batch_id}"))


class AtomicSinks:
    """Several outputs of a micro-batch that become visible together.

    Each is written to its own folder; the batch counts once its commit
    record is there, and readers take rows of committed batches only.  A
    failure between two outputs leaves none visible, and the retry of the
    batch overwrites them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def write(self, batch_id: int, outputs: dict[str, DataFrame]) -> None:
        for name, df in outputs.items():
            df.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch_id}")
        self.spark.createDataFrame([(batch_id,)], "committed int").coalesce(1).write.mode("overwrite") \
            .parquet(f"{self.root}/commits/batch={batch_id}")

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        path, commits = f"{self.root}/{name}", f"{self.root}/commits"
        if not exists(self.spark, commits) or not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        batch = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
        done = self.spark.read.schema("committed int").parquet(f"{commits}/batch=*")
        rows = self.spark.read.schema(batch).parquet(path)
        return rows.join(done, F.col("batch") == F.col("committed"), "left_semi").select(*schema.names)
