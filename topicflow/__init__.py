"""topicflow: keyed event-log analytics as plain PySpark DataFrame functions.

A topic is a table (key, value, topic, partition, offset, timestamp,
timestampType, headers); a changelog table is "latest row per key".  Every
operator is a ``DataFrame -> DataFrame`` function usable with ``df.transform``
in batch and, where Spark allows it, under Structured Streaming.
"""

__version__ = "0.1.0"
