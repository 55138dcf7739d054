"""JSON value codec and record headers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_json_all_fields(fields: dict[str, Column]) -> Column:
    """F7 encode: one JSON object with every field, nulls written as null.
    ``fields`` maps JSON name -> column, in output order."""
    s = F.struct(*[_c(v).alias(k) for k, v in fields.items()])
    return F.to_json(s, {"ignoreNullFields": "false"})


def from_json_strict(c, schema: T.StructType) -> Column:
    """F7 decode: malformed JSON fails the job (FAILFAST); fields that are not
    in the class fail too, as a bare object mapper does."""
    c = _c(c)
    parsed = F.from_json(c, schema, {"mode": "FAILFAST"})
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    unknown = F.array_except(F.json_object_keys(c), known)
    return F.when(c.isNull(), F.lit(None).cast(schema)).when(
        F.size(unknown) > 0,
        F.raise_error(F.concat(F.lit("unknown JSON field(s): "),
                               F.array_join(unknown, ","))).cast(schema),
    ).otherwise(parsed)


def decode_utf8(c) -> Column:
    return F.decode(_c(c), "UTF-8")


def make_header(name: str, value) -> Column:
    """K7: one record header ``(name, bytes of the decimal text)``."""
    return F.struct(F.lit(name).alias("key"),
                    F.encode(_c(value).cast("string"), "UTF-8").alias("value"))


def header_long(value_col) -> Column:
    """header bytes -> ``Long.parseLong`` of the UTF-8 text; a value that
    does not parse gives null (the caller drops and counts it, Q6)."""
    s = F.decode(_c(value_col), "UTF-8")
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("long"))
