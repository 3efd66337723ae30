"""Spark session defaults used by tests, the bench and the examples.

Library code never creates a session; it takes the caller's.  The only
setting it may add is a checkpoint directory, and only when the session has
none (local runs and tests): on a cluster ``spark.checkpoint.dir`` names a
shared folder and is used as is.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from static size estimates: joins broadcast only through
    # checked_broadcast (a bounded row count) or at runtime through AQE, which
    # measures the shuffled side before switching to a broadcast.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Groups a task keeps in an object hash aggregate (grain.first_by, quality.unique_keys) before it sorts.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "indicatormart", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the models assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    driver_mem = os.environ.get("INDICATORMART_DRIVER_MEMORY")
    if driver_mem:
        builder = builder.config("spark.driver.memory", driver_mem)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session, None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key, None) or None
    except Exception:  # noqa: BLE001
        return None


def session_id(spark: SparkSession) -> str:
    """A key identifying the running application (for per-session caches)."""
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return _conf(spark, "spark.app.id") or f"session-{id(spark)}"


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return max(1, sc.defaultParallelism)
    return max(1, int(_conf(spark, "spark.default.parallelism") or 8))


_LOCAL_DIRS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder for checkpoints and written scratch tables, if any."""
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    return current or _conf(spark, "spark.checkpoint.dir") or _LOCAL_DIRS.get(session_id(spark))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    A local temporary folder is created only for local sessions (tests,
    single-machine runs).  A cluster session without ``spark.checkpoint.dir``
    is an error: written tables must live in a folder every executor sees.
    """
    current = checkpoint_dir(spark)
    sc = _context(spark)
    if not current:
        master = (sc.master if sc is not None else _conf(spark, "spark.master")) or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                               "distributed file system) before building models on a cluster")
        current = tempfile.mkdtemp(prefix="indicatormart-ckpt-")
        _LOCAL_DIRS[session_id(spark)] = current
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    return current
