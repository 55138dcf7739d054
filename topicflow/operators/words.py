"""Word counts (W4, W5): tokenising (P4/F1), running totals (A6), tumbling
and hopping windowed counts (A5, TW1, TW2), their printed form (P3) and the
flush-and-reset count (A8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from topicflow.functions.java import split_words
from topicflow.schemas import FLUSH_INTERVAL_MS, WORDCOUNT_WINDOW_MS


def tokenize(df: DataFrame, value_col: str = "value", keep=("doc_id",),
             with_position: bool = True) -> DataFrame:
    """One row per token of ``lower(value).split(" ")`` (Java split:
    trailing empties dropped, leading/inner empty tokens kept)."""
    toks = split_words(F.col(value_col))
    cols = [F.col(c) for c in keep if c in df.columns]
    if with_position:
        return df.select(*cols, F.posexplode(toks).alias("pos", "word"))
    return df.select(*cols, F.explode(toks).alias("word"))


def wordcount_total(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Un-windowed count per word (the final state of the table)."""
    return (tokenize(df, value_col, keep=(), with_position=False)
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def _window_spec(size_ms: int, advance_ms: int | None):
    size = f"{size_ms} milliseconds"
    if advance_ms is None or advance_ms == size_ms:
        return size, None
    return size, f"{advance_ms} milliseconds"


def wordcount_windowed(df: DataFrame, size_ms: int = WORDCOUNT_WINDOW_MS,
                       advance_ms: int | None = None, value_col: str = "value",
                       ts_col: str = "timestamp", extra_keys=()) -> DataFrame:
    """A5 / TW1 / TW2: count per (window, word) on the record time; windows
    are epoch aligned ``[start, end)`` and start at or after the epoch.
    Overlap here is at most 5x, where Spark's own ``window`` expansion is
    the right tool (compare the 720x hop of ``top_items_hopping``)."""
    size, slide = _window_spec(size_ms, advance_ms)
    w = F.window(ts_col, size, slide) if slide else F.window(ts_col, size)
    words = df.select(*extra_keys, F.col(ts_col), F.explode(split_words(F.col(value_col))).alias("word"))
    return (words.groupBy(w.alias("w"), *extra_keys, "word").agg(F.count(F.lit(1)).alias("count"))
            .where(F.col("w.start") >= F.lit("1970-01-01 00:00:00").cast("timestamp"))
            .select(F.unix_millis(F.col("w.start")).alias("window_start"),
                    F.unix_millis(F.col("w.end")).alias("window_end"), *extra_keys, "word", "count"))


def format_windowed(counts: DataFrame) -> DataFrame:
    """``key=%s, value=%s, start=%d, end=%d\\n``."""
    return counts.select("window_start", "window_end", "word", "count",
                         F.format_string("key=%s, value=%s, start=%d, end=%d\n", F.col("word"),
                                         F.col("count"), F.col("window_start"),
                                         F.col("window_end")).alias("line"))


def wordcount_flush(df: DataFrame, interval_ms: int = FLUSH_INTERVAL_MS, value_col: str = "value",
                    ts_col: str = "timestamp", by_partition: bool = False,
                    partition_col: str = "partition") -> DataFrame:
    """A8 batch form: what each flush emits — the per-word count since the
    previous flush, i.e. counts per ``interval_ms`` tumbling window, stamped
    with the flush time (window end).  ``by_partition`` keeps the
    reference's per-input-partition counting (Q3)."""
    keys = (partition_col,) if by_partition else ()
    c = wordcount_windowed(df, interval_ms, None, value_col, ts_col, extra_keys=keys)
    return c.select(F.col("window_end").alias("flush_time"), *keys, "word", "count")
