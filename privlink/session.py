"""Session settings and the shared folder for materialised tables."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every privlink job relies on: UTC session zone (text dates and
# parquet timestamps), adaptive execution with skew-join splitting.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | None = None, app: str = "privlink", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the benchmark (not for a cluster, whose
    settings come from spark-submit)."""
    n = cores or int(os.environ.get("BENCH_CPUS", "0") or 0) or os.cpu_count() or 4
    b = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.driver.memory", os.environ.get("PRIVLINK_DRIVER_MEMORY", "4g"))
    )
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local-mode session without one gets a
    fresh private folder, removed when the process ends; on a cluster a missing
    setting is an error, never a machine-local fallback.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
    d = tempfile.mkdtemp(prefix="privlink-ckpt-")
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
_BROADCAST_MEASURED = "spark.sql.adaptive.autoBroadcastJoinThreshold"
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def conf_of(spark: SparkSession, key: str, value: str):
    """``key`` has ``value`` within, and what it had before afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_released(spark: SparkSession):
    """What is written within leaves no shuffle files: the written table replaces
    them, and a chain of jobs holds one job's at a time, not those of all."""
    return conf_of(spark, _RELEASE, "true")


@contextlib.contextmanager
def joins_by_measured_size(spark: SparkSession):
    """Within, a side of a join is broadcast only if AQE has measured it as small, as rows.

    A plan made before anything ran goes by the size of the files. Packed hand-offs are some
    tens of times smaller than their rows, which the driver would then have to hold. The
    session's own threshold (-1 too) holds for what was measured."""
    threshold = spark.conf.get(_BROADCAST)
    measured = spark.conf.get(_BROADCAST_MEASURED, None) or threshold
    with conf_of(spark, _BROADCAST_MEASURED, measured), conf_of(spark, _BROADCAST, "-1"):
        yield


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared folder for a written table."""
    import uuid

    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
