"""Line validation and typed parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from topicflow.schemas import DATETIME_FORMAT

INT_PATTERN = r"^[+-]?[0-9]+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# fixed values (JDK): the characters Character.isWhitespace accepts — the
# blanks of isNoneBlank: tab, line feed, vertical tab, form feed, carriage
# return, the four information separators, space, and the Unicode space /
# line / paragraph separators other than the no-break ones
JAVA_WHITESPACE = ("\t\n\u000b\f\r\u001c\u001d\u001e\u001f\u0020\u1680"
                   "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a"
                   "\u2028\u2029\u205f\u3000")


def is_not_blank(c) -> Column:
    """not null, not empty, not only whitespace (``isNoneBlank``).  A
    trim over the whitespace set, cheaper than a regex scan per line."""
    c = _c(c)
    return c.isNotNull() & (F.trim(c, F.lit(JAVA_WHITESPACE)) != F.lit(""))


def parse_int_strict(c, what: str = "integer") -> Column:
    """F5 ``Integer.parseInt``: no blanks allowed; a bad value fails the whole
    job (``raise_error``), overflow fails through the ANSI cast."""
    c = _c(c)
    return F.when(c.isNull(), F.lit(None).cast("int")).when(
        c.rlike(INT_PATTERN), c.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit(f"bad {what}: '"), F.coalesce(c, F.lit("null")),
                               F.lit("'"))).cast("int"))


def parse_double(c) -> Column:
    """F5 ``Double.parseDouble``: surrounding blanks are accepted; anything
    else that is not a number fails the job (ANSI cast)."""
    return F.trim(_c(c)).cast("double")


def parse_datetime_ms(c, fmt: str = DATETIME_FORMAT) -> Column:
    """local date-time text read as UTC, to epoch milliseconds.  An
    unparsable value fails the job (ANSI)."""
    c = _c(c)
    ts = F.to_timestamp(c, fmt)
    return F.when(ts.isNull() & c.isNotNull(),
                  F.raise_error(F.concat(F.lit("bad datetime: '"), c, F.lit("'")))
                  .cast("long")).otherwise(F.unix_millis(ts))


def format_time(c, fmt: str) -> Column:
    """Render a timestamp (or epoch ms) with a JVM pattern."""
    c = _c(c)
    return F.date_format(c, fmt)
