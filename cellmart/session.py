"""Session construction and shared scratch locations.

The engine never picks a machine-local temporary folder on its own: intermediate tables,
round-trip files and streaming checkpoints live below the shared folder the cluster names in
``spark.checkpoint.dir``. Only a local session without that setting (a unit test) gets one here;
on a cluster the setting is required.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from real shuffle sizes (turning a
# sort-merge join into a broadcast join when one side turns out small, splitting skewed
# partitions, coalescing tiny ones). Dynamic partition overwrite lets a load replace one
# period without touching the others.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # Shuffled bytes are compressed; in memory a partition is several times as large, and a task may sort
    # it for each of its joins.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Broadcast only below a checked size: the planner compares its size estimate of the
    # build side with this bound and falls back to a sort-merge join above it. The estimate comes from the
    # bytes of compressed files, a column of keys takes many times as much in the driver's hash table, so
    # its bound is small; AQE knows the bytes of the rows.
    "spark.sql.autoBroadcastJoinThreshold": str(1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(8 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
    # Folders of a table are listed by this many tasks, not by one task for each day.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "cellmart", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not shuffle_partitions:
        size_shuffle(spark)
    ensure_checkpoint_dir(spark)
    return spark


def size_shuffle(spark: SparkSession, per_slot: int = 4, floor: int = 200) -> int:
    """Shuffle partitions from the cluster's task slots: at least ``per_slot`` partitions per
    slot, so a large shuffle never lands a few hundred GB on one reducer; AQE merges the small
    ones back to the advisory size when the data turns out smaller."""
    n = max(floor, per_slot * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


#: Bytes of input files for each shuffle partition that AQE starts from.
INPUT_PER_PARTITION = 4 << 20


def size_initial_partitions(spark: SparkSession, folder: str) -> int:
    """Shuffle partitions that AQE starts from and merges to the advisory size: as many as the session has, or
    more by the bytes of the input below ``folder``, so that a task's share does not grow with the input."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    size = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // INPUT_PER_PARTITION))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


def initial_partitions(spark: SparkSession) -> int:
    """Shuffle partitions that AQE starts from in this session."""
    plain = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", plain))


def apply_sql_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of ``BASE_CONF`` (the ``spark.sql.*`` keys) to a
    session built elsewhere, e.g. by a scheduler or a notebook."""
    for key, value in BASE_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)


@contextmanager
def sql_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for the writes within."""
    old = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: The shuffle files of a write go when it has ended. Else they stay on the disks until the driver collects its
#: garbage, through a chain of writes for good.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

#: Rows that lie by partition already, or nearly so, are written as they come: a task keeps this many files open before it
#: sorts its rows by partition.
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "32"}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. A private one is created only when none is set and the
    master is ``local[...]``: executors on other machines would write to their own disks."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="cellmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder for one job's files."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/cellmart/{name}-{uuid.uuid4().hex[:12]}"
