"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the plans of this package count on. All but the last are Spark's own
# defaults; they are pinned so that a site-wide override is seen here first.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS; ``settings`` use ``__`` for the dots in a name."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    chosen = SETTINGS | {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in chosen.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Without ``spark.checkpoint.dir`` a one-machine session gets a temporary
    folder and a cluster session its warehouse folder, unless that is one of the
    machine's own. What is written there is the folder's owner's to remove: the
    DataFrames that read it may outlive the call that wrote it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.conf.get("spark.master", "")
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="kudosflow-")
    folder = spark.conf.get("spark.sql.warehouse.dir")
    if folder.startswith("file:") or "://" not in folder and not _has_shared_default(spark):
        raise ValueError(
            f"executors cannot share {folder}: set spark.checkpoint.dir to a folder they can"
        )
    return folder


def _has_shared_default(spark: SparkSession) -> bool:
    """Whether paths without a scheme go to a file system other than the machine's own."""
    default = spark.conf.get("spark.hadoop.fs.defaultFS", None) or "file:///"
    return not default.startswith("file:")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/kudosflow-{uuid.uuid4().hex}/{name}"
