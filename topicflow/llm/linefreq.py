"""Quality rules with cross-document line frequency, in DataFrame functions
only.

Lines are normalised (lower case, everything but letters blank) and hashed;
for every host (``source``) the documents that hold a line are counted; lines
in LINE_DOCS documents of a host or more, however many it has, are taken out,
and a document is rejected when too little is left of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, staged

MIN_WORDS = 50
MAX_REPEATED = 50      # percent of words in repeated 3-word windows
LINE_DOCS = 100        # a line is taken out of a host's documents if so many hold it
LEAST_LEFT = 30        # percent of words that must remain

_BLANK = " \t\n\x0b\f\r"
_BLANKS = r"[\x20\x09-\x0D]+"
_POSITION_BITS = 22


def words_of(text: Column) -> Column:
    """Array of the words of a text that is not null."""
    inner = F.btrim(text, F.lit(_BLANK))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _BLANKS))


def with_repeated_window_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """``df`` plus how many of ``words`` stand in 3-word windows that occur
    twice or more.

    Windows are hashed and sorted together with their positions; neighbours
    of one hash that hold the same words are repeats, and the words they
    cover follow from the distances between their positions.  Position and
    hash share one long, so that the sort is a primitive one; texts of 2^22
    words or more sort pairs of hash and position instead.  Each step is a
    column of its own, so that it is computed once a row."""
    mask = (1 << _POSITION_BITS) - 1

    def at(i):
        return F.get(F.col(words), i)

    def window_hash(i):
        return F.xxhash64(at(i), at(i + 1), at(i + 2))

    def repeats(ordered, same_hash, position):
        def same(k, other):
            e, f = F.get(F.col(ordered), k), F.get(F.col(ordered), other)
            p, q = position(e), position(f)
            return same_hash(e, f) & (at(p) == at(q)) & (at(p + 1) == at(q + 1)) & (at(p + 2) == at(q + 2))

        return F.filter(F.transform(F.col(ordered), lambda e, k: F.when(same(k, k - 1) | same(k, k + 1), position(e))),
                        lambda p: p.isNotNull())

    windows = F.sequence(F.lit(0), F.size(words) - 3)
    small, large = F.size(words).between(3, mask), F.size(words) > mask
    df = df.withColumns({
        "_packed": F.when(small, F.sort_array(F.transform(
            windows, lambda i: window_hash(i).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))))),
        "_pairs": F.when(large, F.sort_array(F.transform(
            windows, lambda i: F.struct(window_hash(i).alias("h"), i.alias("p")))))})
    df = df.withColumn("_repeats", F.sort_array(
        F.when(small, repeats("_packed", lambda a, b: F.shiftright(a, _POSITION_BITS) == F.shiftright(b, _POSITION_BITS),
                              lambda e: e.bitwiseAND(F.lit(mask)).cast("int")))
        .when(large, repeats("_pairs", lambda a, b: a["h"] == b["h"], lambda e: e["p"]))))
    start = F.struct(F.lit(-3).alias("before"), F.lit(0).alias("words"))
    covered = F.aggregate("_repeats", start, lambda acc, p: F.struct(
        p.alias("before"), (acc["words"] + F.least(F.lit(3), p - acc["before"])).alias("words")))["words"]
    return df.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop("_packed", "_pairs", "_repeats")


def line_rules(spark: SparkSession, docs: DataFrame, line_docs: int = LINE_DOCS, least_left: int = LEAST_LEFT) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, line_words, removed_words, kept) of every row of ``docs``:
    the counts and the verdict of :func:`cleaned`, without moving the texts.

    A null text is an empty one, a null source a host of its own; documents
    with equal texts count each, rows of one id (null included) once; lines
    without a letter are never taken out; repeated rows stay; an empty table
    gives no rows; other columns are not read."""
    return _ruled(spark, docs, line_docs, least_left)


def cleaned(spark: SparkSession, docs: DataFrame, line_docs: int = LINE_DOCS, least_left: int = LEAST_LEFT) -> DataFrame:
    """The columns of :func:`line_rules` and ``text``, the whole text without
    the lines taken out, of every row of ``docs``; those to go on with are
    ``kept``.  Lines that stay are unchanged and in their order, also those
    without a letter; a null text stays null."""
    return _ruled(spark, docs, line_docs, least_left, "text")


def _ruled(spark: SparkSession, docs: DataFrame, line_docs: int, least_left: int, *whole: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("host"), F.col("source").isNull().alias("no_host"),
        text.alias("text"), F.col("text").isNull().alias("no_text"), words_of(text).alias("words"))
    normalised = F.split(F.regexp_replace(F.lower("text"), r"[^\p{L}\n]+", " "), "\n")
    filled = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    rows = with_repeated_window_words(rows, "words", "n_repeat_words").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "host", "no_host",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(filled) - F.size(F.array_distinct(filled))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform(F.filter(F.transform(normalised, lambda x: F.btrim(x)), lambda x: x != ""),
                    lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(F.split(x, " ")).alias("words"))).alias("lines"),
        *(["text", "no_text"] if whole else []))
    rows = staged(spark, rows, "line-rules")

    host = ["host", "no_host"]
    holders = (rows.select(*host, "doc_id", F.explode(F.array_distinct("lines.line")).alias("line")).distinct()
               .groupBy(*host, "line").agg(F.count(F.lit(1)).alias("holders")))
    frequent = staged(spark, holders.where(F.col("holders") >= line_docs).select(*host, "line"), "frequent-lines")
    removed = (rows.select("row", *host, F.explode("lines").alias("l")).select("row", *host, "l.line", "l.words")
               .join(frequent, [*host, "line"]).groupBy("row").agg(F.sum("words").alias("removed_words"), *([F.collect_set("line").alias("taken")] if whole else [])))
    out = rows.join(removed, "row", "left").select(
        "*", F.coalesce("removed_words", F.lit(0)).alias("gone"),
        F.aggregate("lines.words", F.lit(0).cast("long"), lambda a, x: a + x).alias("line_words"))
    # the lines of the text and the normalised ones stand at the same places
    left = F.transform(F.filter(F.arrays_zip(F.split("text", "\n").alias("line"), normalised.alias("key")),
                                lambda x: (F.btrim(x["key"]) == "") | ~F.array_contains("taken", F.xxhash64(F.btrim(x["key"])))), lambda x: x["line"])
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    depleted = (F.col("line_words") - F.col("gone")) * 100 < F.col("line_words") * least_left
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), "line_words", F.col("gone").cast("long").alias("removed_words"),
                      (~failed & ~depleted).alias("kept"),
                      *([F.when(F.col("no_text"), None).when(F.col("taken").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text")]
                        if whole else []))
