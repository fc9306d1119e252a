"""Session construction and lineage cutting.

The library never picks a machine-local folder on a cluster: ``checkpoint_dir``
reads ``spark.checkpoint.dir`` from the session (the shared folder the cluster
names). Only a ``local`` master may do without; it gets a fresh temp folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "roadbook", cpus: int | str = "*", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """A local session configured the way the operators expect.

    On a cluster, build the session with the cluster's own settings instead;
    the operators only rely on defaults that Spark 4 already has (AQE on,
    ANSI on). Recommended on clusters too: ``spark.sql.codegen.hugeMethodLimit
    = 8000`` (wide CASE chains otherwise compile to methods the JVM will not
    JIT-compile).
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.driver.memory", os.environ.get("ROADBOOK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # a generated method above the JIT's 8000-byte limit runs interpreted;
        # past this limit Spark falls back to per-operator code instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and stage outputs.

    Reads ``spark.checkpoint.dir`` from the session. Where it is unset, a
    ``local`` master gets a fresh folder (tests, single-machine runs); on a
    cluster each executor would write to its own disk, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="roadbook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    # keep SparkContext in sync so DataFrame.checkpoint() uses the same folder
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    This is how a stage output is shared by several later plans (and how
    lineage is cut): the written table survives executor loss, unlike a
    cached or locally checkpointed one, and the reader gets file statistics
    that let the planner size joins against it.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    if partition_by:
        # balanced by adaptive execution: skewed values split, small ones merged
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def cluster_conf(total_input_bytes: int | None = None, executors: int | None = None,
                 cores_per_executor: int = 4) -> dict[str, str]:
    """Settings the operators are designed around, for a cluster session.

    Shuffle partitions are sized from the input when it is known: about one
    per 2 GB of input (projections and partial aggregation shrink what is
    shuffled well below the input), at least two per task slot and at most
    65,536 so the map x reduce block count stays manageable; AQE then
    coalesces small partitions and splits skewed ones. File splits stay at
    128 MB. The checkpoint folder is not set here: it is the cluster's shared
    ``spark.checkpoint.dir``.
    """
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
    }
    if total_input_bytes:
        parts = max(200, total_input_bytes // (2 * 1024 ** 3))
        if executors:
            parts = max(parts, 2 * executors * cores_per_executor)
        conf["spark.sql.shuffle.partitions"] = str(int(min(parts, 65536)))
    return conf
