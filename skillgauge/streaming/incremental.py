"""Score newly arrived submissions once, as a batch or as a stream.

A submission is scored as a whole: one uncovered row in any of its files, or a file listed in the
registry without rows, leaves it pending, to be tried again by the next run. Writes replace the partitions of the scored experiments, so a batch
that is replayed after a failure gives the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillgauge.operators.registry import parse_registry, pending, registry_files
from skillgauge.operators.scoring import metrics_and_coverage
from skillgauge.operators.truth import join_truth
from skillgauge.sources import stores
from skillgauge.sources.registry import stream_registry

SUBMISSION_KEYS = ["model", "val_strategy"]
SCORED, FAILED = "scored", "failed"

STATUS_SCHEMA = T.StructType([
    T.StructField("rows", T.LongType()),
    T.StructField("unmatched", T.LongType()),
    T.StructField("absent", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("val_strategy", T.StringType()),
])


FILES_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("setting", "target", *SUBMISSION_KEYS)])


@dataclass(frozen=True)
class Store:
    """Folders of the metrics, status and listed-files tables."""

    root: str

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    @property
    def status(self) -> str:
        return f"{self.root}/status"

    @property
    def files(self) -> str:
        return f"{self.root}/files"

    def read_files(self, spark: SparkSession) -> DataFrame:
        return stores._read_or_empty(spark, self.files, FILES_SCHEMA)

    def read_status(self, spark: SparkSession) -> DataFrame:
        return stores._read_or_empty(spark, self.status, STATUS_SCHEMA)


def unscored(submissions: DataFrame, status: DataFrame) -> DataFrame:
    """Submissions without a ``scored`` status; failed ones are included."""
    done = status.where(F.col("status") == SCORED).select(*SUBMISSION_KEYS)
    return submissions.join(done, SUBMISSION_KEYS, "left_anti")


def listed_files(registry: DataFrame) -> DataFrame:
    """(setting, target, model, val_strategy) of every file the registry's documents list."""
    entries = registry_files(parse_registry(registry)).withColumnRenamed("model_id", "model")
    return entries.select(*FILES_SCHEMA.names).distinct()


def score_submissions(
    submissions: DataFrame, predictions: DataFrame, truth: DataFrame, files: DataFrame, **options
) -> tuple[DataFrame, DataFrame]:
    """``(metrics, status)`` of the listed submissions (model, val_strategy). ``files`` names the
    (setting, target) each must cover. Metrics of those that fail are not computed.

    Submissions and their status, one row each, are staged: their true size is known to the joins, which then need not
    shuffle the rows by the few submissions there are."""
    submissions = stores.stage(submissions.select(*SUBMISSION_KEYS).distinct(), "submissions")
    wanted = predictions.join(submissions, SUBMISSION_KEYS, "left_semi")
    judged = []

    def good(covered: DataFrame) -> DataFrame:
        status = stores.stage(_status(submissions, covered, files), "status")
        judged.append(status)
        return status.where(F.col("status") == SCORED).select(*SUBMISSION_KEYS)

    metrics, _ = metrics_and_coverage(join_truth(wanted, truth), chosen=good, **options)
    return metrics, judged[0]


def _status(submissions: DataFrame, covered: DataFrame, files: DataFrame) -> DataFrame:
    """Rows, uncovered rows and absent files of each submission, and whether it can be scored."""
    found = covered.groupBy(*SUBMISSION_KEYS).agg(F.sum("rows").alias("rows"), F.sum("unmatched").alias("unmatched"))
    lacking = files.join(covered.select(*FILES_SCHEMA.names), FILES_SCHEMA.names, "left_anti").groupBy(*SUBMISSION_KEYS).agg(
        F.count(F.lit(1)).alias("absent"))
    counts = ["rows", "unmatched", "absent"]
    return (
        submissions.join(found, SUBMISSION_KEYS, "left").join(lacking, SUBMISSION_KEYS, "left")
        .na.fill(0, counts)
        .select(
            *counts,
            F.when((F.col("rows") > 0) & (F.col("unmatched") == 0) & (F.col("absent") == 0), SCORED).otherwise(FAILED).alias("status"),
            *SUBMISSION_KEYS,
        )
    )


def score_into(
    store: Store, submissions: DataFrame, predictions: DataFrame, truth: DataFrame, files: DataFrame, **options
) -> None:
    """Score what is not scored yet and record it. Metrics are written before the status, so a
    submission is never marked scored without its metrics."""
    spark = submissions.sparkSession
    todo = unscored(submissions, store.read_status(spark))
    if todo.isEmpty():
        return
    metrics, status = score_submissions(todo, predictions, truth, files, **options)
    stores.write_metrics(stores.stage(metrics, "metrics"), store.metrics)  # without what computing them takes
    stores._replace_partitions(status, store.status, SUBMISSION_KEYS)


def score_pending(store: Store, registry: DataFrame, predictions: DataFrame, truth: DataFrame, **options) -> None:
    """Batch form: every pending submission of the registry."""
    submissions = pending(registry).withColumnRenamed("model_id", "model")
    score_into(store, submissions, predictions, truth, listed_files(registry), **options)


def run_stream(
    spark: SparkSession, registry_folder: str, store: Store, predictions: DataFrame, truth: DataFrame, **options
):
    """Stream form: take the documents that arrived since the last run and stop.

    Failed submissions of earlier runs are taken up again with the next arrivals.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        arrived = pending(batch).withColumnRenamed("model_id", "model").select(*SUBMISSION_KEYS)
        retry = store.read_status(session).where(F.col("status") == FAILED).select(*SUBMISSION_KEYS)
        stores._replace_partitions(listed_files(batch), store.files, SUBMISSION_KEYS)
        score_into(store, arrived.unionByName(retry).distinct(), predictions, truth, store.read_files(session), **options)

    return (
        stream_registry(spark, registry_folder).writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{store.root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
