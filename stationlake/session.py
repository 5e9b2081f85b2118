"""Session construction and the few session settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "stationlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session configured the way every query here assumes.

    * session zone UTC: event time is UTC, hour-of-day and day partitions are UTC;
    * ANSI mode left on (Spark 4 default); the library uses ``try_*`` forms on data;
    * adaptive execution with skew-join splitting and partition coalescing, so a
      station or day holding a third of all rows is split at runtime;
    * no web UI.
    """
    master = master or os.environ.get("SPARK_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the deployment (a shared file system
    every executor and the driver can reach). Only a local-mode session without
    the setting gets a private scratch folder, as in tests.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="stationlake-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, e.g. for one streaming query."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def cluster_settings(input_bytes: int, executors: int, cores_per_executor: int,
                     partition_bytes: int = 256 << 20, shuffle_fraction: float = 0.1) -> dict[str, str]:
    """Session settings for a large deployment, sized from the data read per query.

    * shuffle partitions start at about one per ``partition_bytes`` of expected
      shuffle volume: the analyses shuffle pruned columns after map-side
      combining, estimated as ``shuffle_fraction`` of the input; at least two and at
      most ten waves of task slots. Adaptive execution then coalesces small
      partitions and splits skewed ones, so a partition stays well inside memory;
    * scans take 512 MB splits of the day-partitioned Parquet store;
    * broadcasts that Spark chooses on its own stay small (64 MB estimate);
    * executors that are taken away hand their shuffle and cached blocks to others
      (decommissioning), and lost tasks are retried, so jobs survive executor loss.
    Pass the result as ``extra`` to :func:`get_spark` or as ``--conf`` to spark-submit.
    """
    slots = executors * cores_per_executor
    wanted = -(-int(input_bytes * shuffle_fraction) // partition_bytes)
    partitions = min(max(2 * slots, wanted), 10 * slots)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.storage.decommission.rddBlocks.enabled": "true",
        "spark.task.maxFailures": "8",
    }
