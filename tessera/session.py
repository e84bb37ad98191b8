"""Open or reuse a session (S1) and locate the shared folder for written tables.

Written tables (staged text/CSV inputs, the TF-IDF matrix handed to the SVD,
evaluation logs) go under the folder the cluster names in
``spark.checkpoint.dir``.  That folder is read from the session; only a
local-mode session without it (tests, the bench) gets a folder of our own.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours carries.  AQE re-plans joins and partition
# counts from measured stage sizes; skew-join splitting guards hot join keys.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def sizing_conf(input_bytes: int, total_cores: int,
                partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    Scan splits and shuffle partitions target ``partition_bytes`` each, so
    a task's working set fits in an executor core's memory share whatever
    the scale; the shuffle partition count starts from the input size (at
    least two waves of the cores) and AQE coalesces what turns out small
    and splits skewed partitions of joins.  For 100 TB of input this gives
    about 400,000 shuffle partitions before coalescing.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def get_session(
    app_name: str = "tessera",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Open a session, or return the active one (``getOrCreate``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder for tables written by this application.

    It is the session's checkpoint folder (``spark.checkpoint.dir``, which
    Spark already suffixes with an application-unique id).  A local-mode
    session without one gets a fresh temporary folder; a cluster session
    without one is an error, because a machine-local folder is not visible to
    the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder every executor can "
            "reach (HDFS, object store) before running jobs that write tables"
        )
    return sc.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path under :func:`shared_root`; ``unique`` appends a fresh id."""
    suffix = f"-{uuid.uuid4().hex[:12]}" if unique else ""
    return f"{shared_root(spark)}/tessera/{name}{suffix}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in any store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def collect_garbage(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files and cached blocks of jobs whose
    DataFrames are gone: its cleaner acts when the driver's JVM collects
    garbage, which a large heap puts off while the executors' disks fill."""
    gc.collect()
    spark._jvm.System.gc()
