"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators assume. Session time zone is fixed to UTC because
# source stamps are UTC and report dates are taken with to_date (D16).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast decisions are taken at run time from measured shuffle sizes;
    # this is the checked bound above which a sort-merge join is kept.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "ordermill",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass no ``master``; the launcher decides. Shuffle partitions
    should be sized so that one partition is ~128-256 MB at the target scale.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only a local session without one gets a fresh
    temporary folder (tests), which goes when the process ends. A cluster without it is a configuration error,
    because a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not _is_local(spark):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            d = tempfile.mkdtemp(prefix="ordermill-ckpt-")
            atexit.register(shutil.rmtree, d, ignore_errors=True)
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared folder for intermediate tables."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/ordermill-scratch/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, in whatever file system it is."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are done.

    It does so when the driver has collected the jobs' plans as garbage, which a large heap puts off until the disk is full.
    """
    spark.sparkContext._jvm.System.gc()


def require_utc(spark: SparkSession) -> None:
    tz = spark.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"session time zone must be UTC, got {tz}")


__all__ = ["get_session", "shared_dir", "scratch_path", "remove", "free_shuffles", "require_utc", "DEFAULT_CONF"]
