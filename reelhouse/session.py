"""Session settings, and the shared folder for everything a job has to put down on the way."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Re-planning at run time: coalesce small shuffle partitions, split the skewed ones of a sort-merge
# join, turn a join into a broadcast one only after its side was measured.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str, cpus: str = "8", **extra: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitter makes the session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under `spark.checkpoint.dir`, the place every executor can reach.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):  # local-cluster is a cluster
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="reelhouse-")
    return f"{root.rstrip('/')}/reelhouse/{purpose}-{uuid.uuid4().hex}"
