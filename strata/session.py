"""Session settings (L6-L8) and the shared staging folder.

Settings are explicit arguments with defaults instead of environment lookups.
Nothing here sets a master: deployment decides that.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession


_made: set[str] = set()


@dataclass(frozen=True)
class Settings:
    """Tuning knobs of a history job. Defaults are the reference's gold defaults."""

    app_name: str = "strata"
    time_zone: str = "UTC"
    shuffle_partitions: int = 96
    advisory_partition_size: str = "64m"
    max_partition_bytes: str = "128m"
    adaptive: bool = True
    skew_join: bool = True
    coalesce_partitions: bool = True
    executor_memory: str | None = "2g"
    executor_cores: str | None = "2"
    executor_memory_overhead: str | None = "1g"
    network_timeout: str = "600s"
    shuffle_max_retries: str = "10"
    shuffle_retry_wait: str = "5s"
    kryo: bool = True
    checkpoint_dir: str | None = None
    #: Any further Spark options (SQL extensions, catalogs, packages, executor environment); they win.
    extra: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def for_scale(
        cls,
        input_bytes: float,
        cores: int,
        target_partition_bytes: int = 1024**3,
        expansion: float = 2.0,
        executor_cores: int = 4,
        **overrides,
    ) -> "Settings":
        """Size shuffles, file splits and executors for ``input_bytes`` on ``cores`` task slots.

        AQE only *coalesces* shuffle partitions (and splits skewed join partitions), so
        the initial shuffle width must fit the biggest shuffle: input x ``expansion``
        (decompressed rows, as-of fan-out) / ``target_partition_bytes``, and at least two
        waves of the cluster's slots. AQE merges small partitions back towards the
        target; file splits use the same size. Executors get about two partitions of
        execution memory per core (execution + storage share ~60% of the heap).
        """
        partitions = max(2 * cores, math.ceil(input_bytes * expansion / target_partition_bytes))
        size = f"{max(1, target_partition_bytes // 1024**2)}m"
        heap_gb = max(2, math.ceil(executor_cores * 2 * target_partition_bytes / 0.6 / 1024**3))
        base = cls(
            shuffle_partitions=partitions,
            advisory_partition_size=size,
            max_partition_bytes=size,
            executor_cores=str(executor_cores),
            executor_memory=f"{heap_gb}g",
            executor_memory_overhead=f"{max(1, heap_gb // 4)}g",
        )
        return replace(base, **overrides)

    def static_conf(self) -> dict[str, str]:
        """Options that must be set before the session starts."""
        conf = {
            "spark.sql.session.timeZone": self.time_zone,
            "spark.network.timeout": self.network_timeout,
            "spark.shuffle.io.maxRetries": self.shuffle_max_retries,
            "spark.shuffle.io.retryWait": self.shuffle_retry_wait,
            "spark.ui.enabled": "false",
        }
        if self.executor_memory:
            conf["spark.executor.memory"] = self.executor_memory
        if self.executor_cores:
            conf["spark.executor.cores"] = self.executor_cores
        if self.executor_memory_overhead:
            conf["spark.executor.memoryOverhead"] = self.executor_memory_overhead
        if self.kryo:
            conf["spark.serializer"] = "org.apache.spark.serializer.KryoSerializer"
        if self.checkpoint_dir:
            conf["spark.checkpoint.dir"] = self.checkpoint_dir
        return conf

    def sql_conf(self) -> dict[str, str]:
        """Runtime SQL options (L7): shuffle width and adaptive execution."""
        return {
            "spark.sql.shuffle.partitions": str(self.shuffle_partitions),
            "spark.sql.adaptive.enabled": str(self.adaptive).lower(),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": self.advisory_partition_size,
            "spark.sql.files.maxPartitionBytes": self.max_partition_bytes,
            "spark.sql.adaptive.skewJoin.enabled": str(self.skew_join).lower(),
            "spark.sql.adaptive.coalescePartitions.enabled": str(self.coalesce_partitions).lower(),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(self.shuffle_partitions),
        }


def build_session(settings: Settings = Settings(), master: str | None = None) -> SparkSession:
    """Create or attach to a session with ``settings`` applied."""
    builder = SparkSession.builder.appName(settings.app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**settings.static_conf(), **settings.sql_conf(), **settings.extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_sql_settings(spark, settings)
    return spark


def apply_sql_settings(spark: SparkSession, settings: Settings = Settings()) -> None:
    """Set the runtime options, and those of ``settings.extra`` that a running session can change."""
    for key, value in settings.sql_conf().items():
        spark.conf.set(key, value)
    for key, value in settings.extra.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared staging folder, taken from ``spark.checkpoint.dir``.

    On a cluster the setting must name a shared file system (HDFS, object store);
    a machine-local folder would not survive the loss of an executor. Only a
    local-mode session without the setting (tests, the bench) gets a fresh
    temporary folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder (parquet cannot overwrite what it reads)."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _made.add(path)
    return path


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Staged copies made inside are deleted at the end, also after a failure.

    For jobs that write their results: whatever was read from the copies is in a table by then. A lazy result
    that is used after the block must not read a copy made in it.
    """
    before = set(_made)
    try:
        yield
    finally:
        for path in _made - before:
            release(spark, path)


def release(spark: SparkSession, path: str) -> bool:
    """Delete a staged folder once nothing reads it any more (the counterpart of clearing a cache).

    Only paths that :func:`fresh_path` made in this process are deleted; others are left, and False is
    returned.
    """
    if path not in _made:
        return False
    _made.discard(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True))
