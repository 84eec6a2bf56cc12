"""SparkSession construction and the shared working folder.

Local runs use small shuffle counts; other masters get ``CLUSTER_CONF``, meant for a
1000-executor cluster reading ~100 TB (AQE sizes the reducers at run time, so the static
partition count is only an upper bound for coalescing).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every pacewise job relies on (UTC wall clock, AQE, deterministic partition typing).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.default.parallelism": "8",
    "spark.driver.memory": "16g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Tiny test data: keep up to 8 reducers so writes of many small partition files run on all
    # cores instead of being coalesced into one or two tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
}

# ~100 TB on ~1000 executors: 256 MB input splits, 256 MB advisory shuffle partitions,
# a high initial reducer count that AQE coalesces down, skew splitting above 1 GB.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "32000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxRecordsPerFile": "20000000",
}


def get_session(master: str | None = None, app: str = "pacewise",
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with ``BASE_CONF`` and local defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if not is_local(spark):
        submitted = spark.sparkContext.getConf()
        for k, v in CLUSTER_CONF.items():
            if k not in conf and not submitted.contains(k):
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """One JVM on one machine (``local``, ``local[n]``)."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def ensure_utc(spark: SparkSession) -> None:
    """Day and hour boundaries are UTC; a caller's session may not be pinned yet."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when a local session has none is a fresh scratch folder created and registered as the
    checkpoint directory; on a cluster that is an error, as executors would not see the folder.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return str(current.get())
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("PACEWISE_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A folder for tables written by this application, under the shared checkpoint root."""
    app = spark.sparkContext.applicationId
    return "/".join([checkpoint_root(spark).rstrip("/"), "pacewise", app, *parts])


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, never-used folder for one job run (side-effect queries run on their own copy)."""
    return work_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")
