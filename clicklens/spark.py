"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder that lineage cuts and streaming state live in."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. UTC keeps dates/hours identical to the oracle;
# AQE re-plans joins at run time (broadcast when the measured side is small,
# split skewed partitions, coalesce tiny shuffles).
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "clicklens") -> SparkSession:
    """A local session configured like the cluster jobs (tests, bench, smoke)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Apply the job settings to an existing (cluster) session."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared filesystem folder and is used as
    is. Only a local session (tests) gets a scratch folder when it is unset;
    a cluster session without it is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/...) that every node can reach"
            )
        conf_dir = tempfile.mkdtemp(prefix="clicklens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    Scan splits of 512 MiB keep the task count manageable (100 TB gives
    about 200k scan tasks). The shuffle starts with enough partitions for
    ~256 MiB each, at least 2 waves of the cluster and at most 200k, which the driver
    can still track: beyond 50 TB they grow to input / 200k (100 TB: 500 MiB). AQE
    coalesces small ones to the advisory size and splits skewed ones.
    """
    mib = 1024 * 1024
    shuffle = max(2 * total_cores, min(200_000, input_bytes // (256 * mib) + 1))
    return {
        "spark.sql.files.maxPartitionBytes": str(512 * mib),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mib),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * mib),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * mib),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mib),
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, total_cores: int) -> None:
    apply_job_conf(spark)
    for k, v in scale_conf(input_bytes, total_cores).items():
        spark.conf.set(k, v)


def cluster_session(app: str = "clicklens", hive: bool = False) -> SparkSession:
    """The job session on a cluster (master and resources come from
    spark-submit); ``hive=True`` reads catalog tables from the metastore."""
    builder = SparkSession.builder.appName(app)
    if hive:
        builder = builder.enableHiveSupport()
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark
