"""Session helpers.

Library functions never create a session; these helpers are for tests, the
bench and command-line drivers.  On a cluster the operator of the job owns
the configuration; we only fill in what is missing.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every topicflow job relies on for correct results.
REQUIRED_CONF = {
    # F4 / event time: epoch-ms values are UTC instants.
    "spark.sql.session.timeZone": "UTC",
    # bad numbers and dates must fail the load (ingest P6).
    "spark.sql.ansi.enabled": "true",
}

# Settings that shape the physical plan; defaults, never forced over a
# cluster's own values.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only behind a size check: the planner's estimate keeps
    # Spark's conservative 10 MB, AQE may broadcast up to 64 MB of *measured*
    # shuffle output; anything larger stays a sort-merge join
    # (see operators.tables.lookup_join).
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "topicflow", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, ANSI)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    conf = {**PLAN_CONF, **REQUIRED_CONF, **(extra or {})}
    # tests only: a checkpoint folder of our own when none is configured
    conf.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="topicflow-ckpt-"))
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the settings correctness depends on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session: ``spark.checkpoint.dir`` (set by the cluster), or
    a checkpoint directory already set on the context.  When neither is set,
    a local session gets a fresh folder under the system temp dir, set on the
    context so that every later call agrees; a cluster, whose executors could
    not see that folder, gets an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="topicflow-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location below the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever file system it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the checkpoint root and read back:
    computed once, and lineage is cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
