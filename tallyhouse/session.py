"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings this library expects. Values can be overridden by the cluster configuration;
# they are only applied by ``build_session`` (tests, bench), never forced on a live session.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tallyhouse", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster, use the cluster's own session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder of the cluster (``spark.checkpoint.dir``).

    Intermediate tables, checkpoints and landed test files go here. The setting is read from
    the session. Only a local session (tests, bench) may leave it unset: a private folder is
    then created and registered. On any other master an unset folder is an error, because a
    machine-local one would be another folder on every executor.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    context = None
    try:
        context = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        pass
    if not current and context is not None:
        current = context.getCheckpointDir()
    if not current:
        if context is None or not re.match(r"local($|\[)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tallyhouse-")
        spark.conf.set("spark.checkpoint.dir", current)
        context.setCheckpointDir(current)
    return current.rstrip("/")


def fresh_scratch_path(spark: SparkSession, prefix: str) -> str:
    """A new, unused path below the shared scratch folder; whoever writes there creates it."""
    return f"{shared_dir(spark)}/{prefix}-{uuid.uuid4().hex}"
