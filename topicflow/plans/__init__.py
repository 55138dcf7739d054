"""Registered queries: each is a Spark plan over the driver tables and,
where SQL can express it, the equivalent DuckDB SQL used as the oracle."""

from topicflow.plans.catalog import QUERIES, ORACLE_SQL, STREAM_QUERIES  # noqa: F401
