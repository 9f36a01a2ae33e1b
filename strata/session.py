"""Session helpers.

On a cluster the session comes from the launcher and every setting below is
already decided there; ``get_session`` only fills in what is unset, so tests
and local runs get sane defaults without overriding a cluster's choices.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkContext
from pyspark.sql import SparkSession

# Defaults for local runs. AQE stays on: it coalesces shuffle partitions,
# splits skewed join partitions and turns sort-merge joins into broadcast
# joins only after measuring the real size of a side at run time.
LOCAL_DEFAULTS = {
    "spark.driver.memory": "8g",  # local mode: the driver JVM is the only executor
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "strata", **conf: str) -> SparkSession:
    """The running session as it is, the launcher's session as it is, or a new local one.

    A session that exists already, or that spark-submit is about to make, gets
    none of these settings: master, partitions, time zone and memory are the
    launcher's choice. Only a plain local start uses ``LOCAL_DEFAULTS``,
    ``conf`` and ``master`` (default ``local[8]``).
    """
    running = SparkSession.getActiveSession()
    if running is None and SparkContext._active_spark_context is not None:
        running = SparkSession.builder.getOrCreate()
    if running is None and "PYSPARK_GATEWAY_PORT" in os.environ:  # started by spark-submit
        running = SparkSession.builder.appName(app).getOrCreate()
    if running is not None:
        return running
    builder = SparkSession.builder.master(master or "local[8]").appName(app)
    for key, value in {**LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Scratch folders of local applications that name no shared folder.
_SCRATCH: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is used as is. Only a local
    session (tests, ``local[N]``) without the setting gets a scratch folder;
    a cluster session without it is an error, because a machine-local folder
    is not visible to other executors and does not survive their loss.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or _SCRATCH.get(context.applicationId)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = _SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="strata-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)


def cluster_conf(input_bytes: float, total_cores: int, executor_memory_gb: float = 16.0) -> dict[str, str]:
    """Settings for a cluster run, sized from the input volume and the core count.

    Meant for the launcher (spark-submit ``--conf`` or the builder); the
    library never sets them on a running cluster session.

    * input splits of 256 MB: a task's working set stays well inside its
      share of executor memory (``executor_memory_gb / cores`` per task);
    * shuffle partitions: about one per GB of input (at least 3 per core), so
      AQE has enough initial partitions to coalesce toward 256 MB targets;
    * skew: a partition over 1 GB and 5× the median is split by AQE;
    * broadcast: only sides measured under 64 MB (AQE checks at run time);
    * streaming state in RocksDB (off-heap, spills to disk) so dedup state
      bounded by the watermark does not pressure the JVM heap;
    * executor loss: decommissioning migrates shuffle and cached blocks, and
      shuffle tracking lets dynamic allocation release executors safely.
    """
    gb = float(input_bytes) / 2**30
    shuffle_parts = int(max(3 * total_cores, min(200_000, gb)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.storage.decommission.rddBlocks.enabled": "true",
        "spark.dynamicAllocation.shuffleTracking.enabled": "true",
        "spark.task.maxFailures": "8",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.executor.memory": f"{int(executor_memory_gb)}g",
    }
