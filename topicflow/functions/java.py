"""JVM string semantics the reference depends on, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_hash(c) -> Column:
    """32-bit ``String.hashCode`` (F8): ``s[0]*31^(n-1) + ... + s[n-1]`` over
    UTF-16 units, wrapping; null stays null.  A deterministic expression over
    the code points (one above U+FFFF is two units), in 32 bits of a long, so
    Catalyst can move filters past it."""
    c = _c(c)
    low = F.lit(0xFFFFFFFF)

    def add(h, unit):
        return (h * 31 + unit).bitwiseAND(low)

    def step(h, ch):
        p = F.ascii(ch).cast("long")
        above = p - 0x10000
        pair = add(add(h, F.lit(0xD800) + F.shiftright(above, 10)), F.lit(0xDC00) + above.bitwiseAND(F.lit(0x3FF)))
        return F.when(p < 0x10000, add(h, p)).otherwise(pair)

    h = F.aggregate(F.filter(F.split(c, ""), lambda ch: ch != ""), F.lit(0).cast("long"), step)
    return F.when(h >= 0x80000000, h - 0x100000000).otherwise(h).cast("int")


def hash_partition_mask(key, n: int, key_type: str = "string") -> Column:
    """M1: ``(hash & 0x7fffffff) % n``; integer keys use their value, a null
    key goes to partition 0.  Long keys are rejected (Q5)."""
    key = _c(key)
    if key_type in ("long", "bigint"):
        raise TypeError("hash partitioner does not accept long keys")
    h = key.cast("int") if key_type in ("int", "integer") else java_hash(key)
    return F.when(key.isNull(), F.lit(0)).otherwise(
        F.pmod(h.bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(n))).cast("int")


def hash_partition_abs(key, n: int, key_type: str = "string") -> Column:
    """M2: ``abs(hash % n)`` (truncating remainder); integer keys ``abs(v) % n``.
    Differs from M1 for negative hashes."""
    key = _c(key)
    if key_type in ("int", "integer"):
        # Math.abs(Integer.MIN_VALUE) is negative; its remainder keeps the sign
        v = key.cast("int")
        a = F.when(v == F.lit(-2147483648), v).otherwise(F.abs(v))
        return (a % F.lit(n)).cast("int")
    h = java_hash(key)
    return F.when(key.isNull(), F.lit(0)).otherwise(F.abs(h % F.lit(n))).cast("int")


def java_split(c, regex: str) -> Column:
    """``String.split(regex)`` with limit 0: trailing empty strings are
    removed, leading and inner ones kept; ``""`` gives ``[""]``.

    Trailing empties are exactly what a run of separator matches at the very
    end of the text produces, so that run is cut off first (``\\z``: the
    absolute end, unlike ``$``) and the rest is split keeping everything —
    plain regex built-ins, no per-element lambda."""
    c = _c(c)
    body = F.regexp_replace(c, f"(?:{regex})+\\z", "")
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(body == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(body, regex, -1)))


def split_words(c) -> Column:
    """``toLowerCase().split(" ")``.  A run of trailing blanks only adds
    trailing empties, so trimming them first gives the same tokens without
    the array scan; an all-blank string gives no tokens."""
    c = _c(c)
    low = F.lower(c)
    trimmed = F.rtrim(low)
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(trimmed == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ", -1)))


def java_str(c) -> Column:
    """String concatenation prints ``null`` for null values."""
    return F.coalesce(_c(c).cast("string"), F.lit("null"))
