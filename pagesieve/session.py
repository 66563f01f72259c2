"""Session helpers: the settings every job in this package expects."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on; a cluster session usually sets most of them.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files once the checkpointed DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Suggested settings for a large cluster (~100 TB of pages, ~1,000 executors).
# The page scan is CPU bound (regex + folds per row), so input splits are kept
# smaller than the default; shuffles start wide and AQE coalesces them to
# ~256 MB and splits skewed partitions; rebalanced writes aim at ~512 MB files.
CLUSTER_CONF = {
    **RECOMMENDED_CONF,
    "spark.sql.files.maxPartitionBytes": str(64 << 20),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "pagesieve", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings used in tests and bench."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str | None) -> bool:
    """Whether driver and executors are one process (``local-cluster`` isn't)."""
    return bool(master) and (master == "local" or master.startswith("local["))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster's ``spark.checkpoint.dir`` wins; only in a local session, as
    in tests, is a private scratch folder made when it is unset. Elsewhere a
    missing setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session manages its own checkpoint folder
        return current or ""
    if not current:
        current = sc.getCheckpointDir()
    if not current:
        if not is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share: "
                               "a folder of the driver's machine would not be seen by them")
        current = tempfile.mkdtemp(prefix="pagesieve-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


_WRITTEN: list[str] = []


def drop_scratch() -> None:
    """Delete the scratch tables and folders this driver wrote. Runs at
    driver exit (no job can read them any more; derived DataFrames may read
    them until then); call it before stopping the session to clean up early."""
    spark = SparkSession.getActiveSession()
    if spark is None or not _WRITTEN:
        return
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _WRITTEN:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
    except Exception:  # noqa: BLE001 - best effort at shutdown
        pass
    _WRITTEN.clear()


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder under the shared checkpoint folder, deleted when the
    driver process exits."""
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/pagesieve-{kind}/{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(drop_scratch)
    _WRITTEN.append(path)
    return path


def materialize(df):
    """Cut lineage: write ``df`` once as a Parquet table in the shared
    checkpoint folder and read it back. Used where one expensive intermediate
    feeds several branches of a plan. Unlike an unpersisted eager
    ``checkpoint()`` (one job to force it, a second to write the files), the
    data is computed once; the table also gives the planner real size
    statistics, and a lost executor never forces recomputation upstream."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    if not root:  # no shared folder known to this client: use the session's checkpoint
        return df.checkpoint(eager=True)
    path = scratch_path(spark, "tables")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
