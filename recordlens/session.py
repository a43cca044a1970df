"""SparkSession construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, cores: int | None = None,
                  app_name: str = "recordlens", extra: dict | None = None) -> SparkSession:
    """Session tuned for the library: UTC, AQE with skew-join handling.

    ``master=None`` means local mode with ``cores`` threads (tests, bench);
    pass ``master=""`` under spark-submit to keep the cluster's master and
    sizing.  Locally, shuffle partitions follow the core count; on a
    cluster they come from spark-defaults, and AQE coalesces small
    partitions and splits skewed ones at run time.
    """
    cores = cores or int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    local = master is None or master.startswith("local")
    builder = SparkSession.builder.appName(app_name)
    if master is None:
        builder = builder.master(f"local[{cores}]")
    elif master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Streaming state on disk: it may outgrow an executor's heap.
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        # Checkpoint files of DataFrames that are no longer referenced are removed.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if local:
        builder = (builder.config("spark.sql.shuffle.partitions", str(max(cores, 1)))
                   .config("spark.driver.memory", os.environ.get("RECORDLENS_DRIVER_MEMORY", "16g")))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    always used.  Only in local mode (tests, benchmarks) and only when no
    directory is configured do we fall back to a fresh scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions manage checkpoints server-side
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared (cluster-visible) folder is "
            "required to cut lineage reliably")
    scratch = tempfile.mkdtemp(prefix="recordlens-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where later steps must see exactly the same row placement twice
    (e.g. partition-local numbering); a recompute after an executor loss
    then re-reads the checkpoint files instead of re-running a shuffle
    whose row order is not deterministic.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
