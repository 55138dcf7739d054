"""Delimited-line ingest with the reference's validation rules.

``drop blank lines -> split on \\s*,\\s* (Java split: trailing empty fields
removed) -> keep exactly 4 fields -> typed parse``.  A bad number or date
fails the whole load, as the reference's stream pipeline throws.  Spark's
CSV reader has none of these rules, so lines are read as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from topicflow.functions.text import (is_not_blank, parse_datetime_ms, parse_double,
                                      parse_int_strict)

FIELD_SEP = r"\s*,\s*"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files (one ``value`` column)."""
    return spark.read.text(path)


# Java's \\s: the characters the separator regex absorbs around a comma
_WS = " \t\n\u000b\f\r"


def valid_fields(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Non-blank lines split into exactly four fields (``f`` array).

    Splitting on ``\\s*,\\s*`` cuts at every comma (the blanks cannot span
    one) and drops the blanks next to it.  So: cut trailing separators
    (regex, only on lines that end in a comma or blank), split on the single
    character (no regex per line), and trim the blanks that touched a comma
    when a field is read (:func:`_f`): the first field keeps its leading
    blanks, the last its trailing ones, as the regex split does.

    ``f`` is null for any other line and fields are read with ``get``:
    Catalyst may evaluate the typed parse of a field together with (or, by
    common-subexpression elimination, before) the field-count test, so
    nothing here may fail on a line that is about to be dropped."""
    v = F.col(value_col)
    # only a line ending in a comma or blank can have trailing separators
    ends_sep = F.substring(v, -1, 1).isin(",", *_WS)
    body = F.when(ends_sep, F.regexp_replace(v, f"(?:{FIELD_SEP})+\\z", "")).otherwise(v)
    d = (lines.withColumn("__body", body)
         .withColumn("__parts", F.split(F.col("__body"), ",", -1)))
    f = F.when(is_not_blank(v) & (F.size("__parts") == 4), F.col("__parts"))
    return d.select(*lines.columns, f.alias("f")).where(F.col("f").isNotNull())


def _f(i: int, n: int = 4):
    x = F.get(F.col("f"), i)
    ws = F.lit(_WS)
    if i == 0:
        return F.rtrim(x, ws)
    if i == n - 1:
        return F.ltrim(x, ws)
    return F.trim(x, ws)


def parse_orders(lines: DataFrame, value_col: str = "value") -> DataFrame:
    return valid_fields(lines, value_col).select(
        _f(0).alias("user_name"), _f(1).alias("item_name"),
        parse_datetime_ms(_f(2)).alias("transaction_date"),
        parse_int_strict(_f(3), "quantity").alias("quantity"))


def parse_users(lines: DataFrame, value_col: str = "value") -> DataFrame:
    return valid_fields(lines, value_col).select(
        _f(0).alias("name"), _f(1).alias("address"), _f(2).alias("gender"),
        parse_int_strict(_f(3), "age").alias("age"))


def parse_items(lines: DataFrame, value_col: str = "value") -> DataFrame:
    return valid_fields(lines, value_col).select(
        _f(0).alias("item_name"), _f(1).alias("address"), _f(2).alias("type"),
        parse_double(_f(3)).alias("price"))


PARSERS = {"order": parse_orders, "user": parse_users, "item": parse_items}


def ingest(lines: DataFrame, kind: str, value_col: str = "value") -> DataFrame:
    return PARSERS[kind](lines, value_col)
