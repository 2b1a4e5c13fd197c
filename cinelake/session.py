"""Session construction and the shared scratch folder.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names (a shared
file system / object store path).  Only when it is unset (local tests) do we create
our own temporary folder and register it, so lineage can still be cut with
``checkpoint()`` and streaming checkpoints have a home.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

# Settings every job wants regardless of scale.  Sizes (shuffle partitions, max
# partition bytes) are arguments because they depend on the cluster and the data.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the next operator (e.g. the fact's distinct,
    # which groups by the join key) would otherwise reuse the join's partitioning;
    # the extra shuffle is only added when runtime statistics show skew
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # stream state off the heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


MB = 1024 * 1024
# a shuffle has partitions x partitions blocks, all tracked by the driver
MAX_PARTITIONS = 32_768
MAX_SCAN_BYTES = 1024 * MB


def sizing_conf(input_bytes: int, partition_bytes: int = 256 * MB, broadcast_bytes: int = 64 * MB) -> dict[str, str]:
    """Partition sizing for a given input volume (e.g. 100 TB on a large cluster).

    Partitions grow in number up to ``MAX_PARTITIONS`` and in size from there on (100 TB
    gives 32,768 of about 3 GB, spilled as needed); scans split at ``MAX_SCAN_BYTES`` at
    most.  AQE coalesces small partitions back toward the advisory size.  Skew splitting
    starts at twice that.  Broadcasts stay under ``broadcast_bytes`` of measured size."""
    partition_bytes = max(partition_bytes, -(-input_bytes // MAX_PARTITIONS))
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(min(partition_bytes, MAX_SCAN_BYTES)),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }


def build_session(
    master: str | None = None,
    app_name: str = "cinelake",
    shuffle_partitions: int | None = None,
    max_partition_bytes: str | None = None,
    driver_memory: str | None = None,
    extra_conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Session with the settings every job wants.  Sizes are set only where they are
    passed, derived from ``input_bytes`` (``sizing_conf``), or the master is local (8
    shuffle partitions); what spark-submit or the cluster sets stays otherwise."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if max_partition_bytes is not None:
        conf["spark.sql.files.maxPartitionBytes"] = max_partition_bytes
    if input_bytes:
        conf.update(sizing_conf(input_bytes))
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if master and master.startswith("local"):
        spark.sparkContext.setLogLevel("ERROR")
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key, None) or None
    except Exception:  # noqa: BLE001 - some session types raise on unknown keys
        return None


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return _conf(spark, "spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir() appends a per-application uuid folder; use its parent
        return os.path.dirname(current.rstrip("/"))
    return sc.getConf().get("spark.checkpoint.dir", None) or _conf(spark, "spark.checkpoint.dir")


def _master(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.master
    except Exception:  # noqa: BLE001 - Spark Connect: the cluster's business
        return _conf(spark, "spark.master") or ""


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Folders that ``shared_dir`` names inside this block are deleted at its end: for jobs
    whose results are written by then."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove_path(spark, path)


def file_system(spark: SparkSession, path: str):
    """(file system, path) of a location, for existence checks and deletes."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def remove_path(spark: SparkSession, path: str) -> None:
    fs, jpath = file_system(spark, path)
    fs.delete(jpath, True)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session.  Only if it is unset and the master
    is local (tests) a temporary folder is created and registered as the checkpoint dir;
    on a cluster a folder of one machine would lose rows, so that is an error.
    """
    base = _configured_checkpoint_dir(spark)
    if not base:
        if not _master(spark).startswith("local") or _master(spark).startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cinelake-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(base)
        except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
            spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
    if _scratch:
        _scratch[-1].append(path)
    return path


def materialize(df, purpose: str, options: dict | None = None):
    """Write ``df`` once as Parquet under the shared checkpoint folder and return the
    re-read table.  Cuts lineage like ``checkpoint()`` (a lost executor re-reads the
    files instead of recomputing upstream), but the copy is columnar: later scans
    prune columns, push filters down, and give the planner real size statistics.
    ``options`` are the Parquet writer's."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.mode("errorifexists").options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df, purpose: str):
    """``materialize`` that also returns the number of rows written, observed during
    the write itself (no extra pass over the data)."""
    obs = Observation(f"rows-{purpose}-{uuid.uuid4().hex[:12]}")
    path = shared_dir(df.sparkSession, purpose)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), int(obs.get["rows"])


def run_concurrently(*calls):
    """Run independent driver-side calls (each submitting its own Spark jobs) from
    separate threads, so the scheduler overlaps their jobs instead of running them
    back to back.  Returns the results in order; the first error is raised."""
    with ThreadPoolExecutor(max_workers=max(1, len(calls))) as pool:
        futures = [pool.submit(fn, *args) for fn, *args in calls]
        return [f.result() for f in futures]
