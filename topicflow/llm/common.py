"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicflow.session import scratch_path

# Words of every operator here: runs of anything but blank and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"

TEXTS_IN_BATCH = 500    # whole texts that an Arrow batch holds where memory is short

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# digits, letters and everything beyond ASCII make words; A-Z count as a-z
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def folded(text: bytes) -> bytes:
    """UTF-8 ``text``, as long, with blanks between lower-case words."""
    return text.translate(_FOLD)


def folded_words(text: bytes | None) -> list[bytes]:
    return folded(text or b"").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, df: DataFrame, name: str, *folders: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder (in folders
    by the columns ``folders``, its last) and read back: lineage is cut and a
    lost executor costs no recomputation."""
    path = scratch_path(spark, name)
    df.write.partitionBy(*folders).option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Arrow batches of few rows while a table of bulky rows is written."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n`` (null counts as '')."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def slices(column, rows: int = 1_000):
    """An Arrow column as lists of at most ``rows`` values (one if empty), so
    that a task holds few texts at a time."""
    for at in range(0, max(1, len(column)), rows):
        yield column.slice(at, rows).to_pylist()


def most_frequent(df: DataFrame, n: str, limit: int) -> DataFrame:
    """The rows of the largest ``n`` (positive), at most ``limit``: those in
    the upper eighths of an octave that together hold so many.  Sizes come
    from a histogram of some hundred rows; nothing is sorted in one task."""
    level = F.floor(F.log2(n) * 8)
    least, total = None, 0
    for r in df.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("level")).collect():
        total += r.rows
        if total > limit:
            break
        least = r.level
    return df.where(F.lit(False) if least is None else level >= least)


def numbered(df: DataFrame, group: list[str], order: list[str], out: str, buckets: int = 256) -> DataFrame:
    """``df`` with a gapless number from 0 within each ``group``.

    Two levels, so that one group never meets in one task: rows are numbered
    inside hashed buckets of their group, and a bucket's start comes from the
    running sum of the bucket sizes (at most ``buckets`` rows a group).  Rows
    equal in all ``order`` columns are interchangeable.  ``df`` is read twice:
    pass a staged table.  ``group`` columns must not be null."""
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    keys = [*group, "_bucket"]
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
              .select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return (df.withColumn("_inside", inside).join(starts, keys)
            .withColumn(out, (F.col("_start") + F.col("_inside")).cast("long"))
            .drop("_bucket", "_start", "_inside"))
