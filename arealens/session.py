"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.
# * No broadcast from the planner's *estimates*: a compressed Parquet file
#   looks several times smaller than its rows, so estimate-based broadcasting
#   ships large tables.  Broadcasts happen only where a side was counted
#   (``bounded_broadcast``) or where AQE *measured* a finished shuffle stage
#   below the adaptive threshold.
# * AQE also splits skewed join partitions and coalesces small partitions.
_DEFAULTS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "arealens",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the settings above.

    ``master`` is only used when no cluster manager is configured (tests and
    the local bench); on a cluster the submitter decides.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Runtime SQL settings the operators are planned for (broadcast and AQE only);
# applied to a session someone else built (``use_policy``).  The operators
# use try_* functions, so they give the same answers with ANSI mode on or off.
POLICY = {k: v for k, v in _DEFAULTS.items()
          if k.startswith("spark.sql.adaptive.") or k == "spark.sql.autoBroadcastJoinThreshold"}


def use_policy(spark: SparkSession) -> SparkSession:
    """Apply the broadcast / AQE policy above to an existing session."""
    for k, v in POLICY.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach; it is
    read, never replaced.  ``fallback`` is used only when the setting is unset
    (tests, local runs), and is then registered as the session's setting.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if fallback is None:
        raise ValueError("spark.checkpoint.dir is not set and no fallback was given")
    os.makedirs(fallback, exist_ok=True)
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Where it is unset a temporary
    folder takes its place in local mode only (tests, the local bench): on a
    cluster every machine would have its own, so that is an error."""
    local = spark.sparkContext.master.startswith("local") and not spark.conf.get("spark.checkpoint.dir", None)
    return checkpoint_dir(spark, tempfile.mkdtemp(prefix="arealens-shared-") if local else None)
