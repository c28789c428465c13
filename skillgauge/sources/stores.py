"""Parquet tables of the pipeline. All writes replace whole partitions, so a retry is harmless."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.operators.truth import full_manifest
from skillgauge.schema import EXPERIMENT, METRICS_SCHEMA, TRUTH_SCHEMA
from skillgauge.session import shared_folder

_MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # the default drops what is below a millisecond
METRIC_PARTITIONS = ["target", "setting", "model", "val_strategy"]


def _replace_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd").partitionBy(*partitions).parquet(path)
    )


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A store nothing was written to yet reads as empty."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_truth(truth: DataFrame, path: str) -> None:
    """Truth by (setting, target) directory; rows of a partition are ordered by site and time so
    that readers skip row groups."""
    spread = truth.select(*TRUTH_SCHEMA.names).repartitionByRange("setting", "target", "site_id", "time")
    _replace_partitions(spread.sortWithinPartitions("setting", "target", "site_id", "time"), path, ["setting", "target"])


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRUTH_SCHEMA).parquet(path).select(*TRUTH_SCHEMA.names)


def write_manifest(truth: DataFrame, path: str, model: str = "lr", val_strategy: str = "mean") -> None:
    full_manifest(truth, model, val_strategy).write.mode("overwrite").option("timestampNTZFormat", _MICROSECONDS).json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("timestampNTZFormat", _MICROSECONDS).schema(
        "setting string, target string, rows long, sites long, time_min timestamp_ntz, time_max timestamp_ntz, "
        "fingerprint string, total_rows long, truth_model string, val_strategy string"
    ).json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Replace the stored metrics of the experiments in ``metrics`` and keep all others."""
    _replace_partitions(metrics.repartition(*METRIC_PARTITIONS), path, METRIC_PARTITIONS)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, METRICS_SCHEMA)


def missing_experiments(experiments: DataFrame, stored: DataFrame) -> DataFrame:
    """Experiments without stored metrics."""
    return experiments.join(stored.select(*EXPERIMENT).distinct(), EXPERIMENT, "left_anti")


def load_all_metrics(
    spark: SparkSession, path: str, predictions: DataFrame | None = None, settings=None, targets=None, models=None,
    scales=None, val_strategy: str = "mean", rerun: bool = False, dropped=("daily", "monthly"), **options,
) -> DataFrame:
    """Stored metrics, with those not stored yet computed from ``predictions`` and saved.

    ``rerun`` recomputes every selected experiment.
    """
    from skillgauge.operators.scoring import compute_metrics

    def wanted(df: DataFrame) -> DataFrame:
        df = df.where(F.col("val_strategy") == val_strategy)
        for name, values in (("setting", settings), ("target", targets), ("model", models)):
            df = df.where(F.col(name).isin(list(values))) if values else df
        return df

    if predictions is not None:
        todo = wanted(predictions)
        if not rerun:
            todo = missing_experiments(todo, read_metrics(spark, path))
        fresh = compute_metrics(todo, **options)
        write_metrics(fresh, path)
    shown = wanted(read_metrics(spark, path)).where(~F.col("scale").isin(list(dropped)))
    return shown.where(F.col("scale").isin(list(scales))) if scales else shown


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Writes within it remove their shuffle files as soon as they are done. Otherwise these stay until the driver happens
    to collect its garbage, which large data does not hasten."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged within it go at its end, and the shuffles of writes as in ``shuffles_released``: for results that are written before,
    elsewhere."""
    folder = f"{stage_folder(spark)}/scratch-{uuid.uuid4().hex}"
    outer = _scratch.set(folder)
    try:
        with shuffles_released(spark):
            yield
    finally:
        _scratch.reset(outer)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage_folder(spark: SparkSession) -> str:
    """Where tables are staged now."""
    return _scratch.get() or shared_folder(spark)


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a result to the shared folder (or ``folder``) and read it back.

    Cuts the lineage where a costly result is used many times, and survives lost executors. The shuffles it took are removed.
    """
    spark = df.sparkSession
    path = f"{folder or stage_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_leaderboard(table: DataFrame, path: str) -> None:
    _replace_partitions(table, path, ["target", "aggregate"])
