"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

MIB = 1024 * 1024

# One temporary root per local application that names no folder of its own.
_local_roots: dict[str, str] = {}


def shuffle_partitions_for(
    shuffled_bytes: int, target_bytes: int = 128 * MIB, floor: int = 8, ceiling: int = 100_000
) -> int:
    """Shuffle width at which a partition of ``shuffled_bytes`` fits in task memory.

    Adaptive execution merges partitions that turn out small but never adds any, so the
    starting width has to suit the largest shuffle: 100 TB at 128 MiB is 745,059.
    The ceiling keeps shuffle bookkeeping on the driver bounded; beyond it partitions
    grow (1 GB each at 100 TB), which a sorting task spills.
    """
    return min(ceiling, max(floor, math.ceil(shuffled_bytes / target_bytes)))


def build_session(
    app_name: str,
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the jobs rely on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # The standard Parquet timestamp, which has statistics to prune by.
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        # Parsed JSON shrinks several times in Parquet; larger pieces keep the number of
        # files written per run down.
        .config("spark.sql.files.maxPartitionBytes", str(256 * MIB))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 * MIB))
        # Lets a task keep a file open per route, instead of sorting its rows by route.
        .config("spark.sql.maxConcurrentOutputFileWriters", "4")
        # Keeps processing_date a string when partitions are discovered.
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _scratch_root(spark: SparkSession) -> str:
    """The folder below which all scratch tables are, in the one the cluster names in ``spark.checkpoint.dir``.

    Executors must be able to read what other executors wrote there.  Only a local
    session, where driver and executor are one process, may do without the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="sluicegate-")
        root = _local_roots[context.applicationId]
    return f"{root.rstrip('/')}/sluicegate"


def shared_scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that executors share."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def discard_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table written under ``shared_scratch``, on whatever file system it is."""
    parent, _, name = path.rpartition("/")
    if parent != _scratch_root(spark) or not name:
        raise ValueError(f"{path} is not a scratch path")
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
