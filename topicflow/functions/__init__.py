"""Column -> Column helpers.  All are built-in Spark
expressions, so they stay JVM-side inside whole-stage code generation."""

from topicflow.functions.java import (java_hash, java_split, java_str, split_words,
                                      hash_partition_mask, hash_partition_abs)
from topicflow.functions.text import (is_not_blank, parse_int_strict, parse_double,
                                      parse_datetime_ms, format_time)
from topicflow.functions.codec import (to_json_all_fields, from_json_strict, header_long,
                                       make_header, decode_utf8)

__all__ = [
    "java_hash", "java_split", "java_str", "split_words", "hash_partition_mask",
    "hash_partition_abs", "is_not_blank", "parse_int_strict", "parse_double",
    "parse_datetime_ms", "format_time", "to_json_all_fields", "from_json_strict",
    "header_long", "make_header", "decode_utf8",
]
