"""Session helpers.

The library never owns the session: every operator takes and returns
DataFrames. These helpers only build a session for tests / benches and
resolve the shared checkpoint folder the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings that matter at scale: AQE re-plans joins (broadcast when a
# materialised side turns out small), coalesces tiny shuffle partitions and
# splits skewed ones; UTC keeps dates stable across executors.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Suggested settings for a large cluster (e.g. 1000 executors, ~100 TB of
# input). Partition counts follow data size through AQE instead of a fixed
# number; skewed join partitions are split; big broadcasts stay off.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "20000",          # upper bound; AQE coalesces
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
    "regpanel.scan.partitions": "4000",                # order buckets of the scans: ~256 MB each at 1 TB
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "regpanel", extra: dict | None = None,
                  scratch_dir: str | None = None) -> SparkSession:
    """Local session for tests and benches (a cluster session is the caller's)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, scratch_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, scratch_dir: str | None = None) -> str:
    """Return the shared checkpoint folder, setting one only where it is unset.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is (an unset one is an error there, unless the caller names a
    shared ``scratch_dir``). Only a local session without it gets a fresh
    local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if scratch_dir is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage: "
                           "lineage cuts and written tables must survive executor loss")
    base = scratch_dir or tempfile.mkdtemp(prefix="regpanel-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    return base


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for a written table."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again.

    Survives executor loss like a checkpoint, and later reads keep column
    pruning and real sizes (a checkpoint stores whole serialised rows).
    """
    spark = df.sparkSession
    path = checkpoint_path(spark, f"table-{uuid.uuid4().hex}")
    plain = df.withColumns({f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields
                            if isinstance(f.dataType, T.NullType)})
    plain.write.parquet(path)
    return spark.read.schema(plain.schema).parquet(path)
