"""Session settings and the shared work folder.

Every job runs with a UTC session zone, ANSI casts and adaptive query
execution. Intermediate files (staging, outbox, native tables written by the
registered queries) go under the shared folder the cluster names in
``spark.checkpoint.dir``; only when that is unset (local tests) do we pick one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dynamic overwrite lets a replayed consume rewrite only its own partition.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # TIME columns: Parquet keeps them, CSV staging writes them as text.
    "spark.sql.timeType.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "sluice",
                  shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and the bench (a cluster passes its own session)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         # Checkpoints of lineage cuts are removed once no DataFrame needs them.
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in {**SESSION_CONF, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session. Settings that the
    cluster has locked stay as they are, but without ANSI casts (which fail
    where a value does not fit, instead of giving NULL) nothing may run."""
    for k, v in SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:
            if k == "spark.sql.ansi.enabled" and spark.conf.get(k, "false") != "true":
                raise
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``. Where it is unset a
    local session gets a folder of its own; a cluster has to name one, since
    executors would not see a folder on the driver's disk."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="sluice-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder, unique per call."""
    return "/".join([checkpoint_dir(spark), "sluice", *parts, uuid.uuid4().hex])
