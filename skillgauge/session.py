"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that change results (time zone, ANSI) or protect skewed shuffles (AQE).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "skillgauge", **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for stage tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session (tests) may fall
    back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="skillgauge-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
