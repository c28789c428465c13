"""Prediction and metric CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.functions.naming import base_name, experiment_name, parse_file_name
from skillgauge.functions.timeparts import parse_time
from skillgauge.schema import EXPERIMENT, METRICS, METRICS_SCHEMA, PREDICTION_COLUMNS

# Texts that mean a missing number.
MISSING_TEXTS = ["", "na", "n/a", "nan", "-nan", "null", "none", "<na>", "#n/a", "#na"]


def parse_number(text: Column) -> Column:
    """Number of a text; NULL for missing texts and for texts that are no number."""
    low = F.lower(F.trim(text))
    spelled = F.regexp_replace(low, r"^([+-]?)inf(inity)?$", "$1Infinity")
    return F.when(~low.isin(MISSING_TEXTS), spelled.try_cast("double"))


def _is_bad_number(text: Column) -> Column:
    return F.coalesce(~F.lower(F.trim(text)).isin(MISSING_TEXTS) & parse_number(text).isNull(), F.lit(False))


def _is_bad_time(text: Column) -> Column:
    return F.coalesce(text.isNotNull() & parse_time(text).isNull(), F.lit(False))


def _csv(spark: SparkSession, paths: list[str] | str, **options) -> DataFrame:
    # Every column is read as text and cast by name below. A file whose header differs from the
    # first one raises instead of shifting columns.
    return spark.read.options(header=True, enforceSchema=False, **options).csv(paths)


def header_groups(spark: SparkSession, paths: list[str] | str, **options) -> dict[str, list[str]]:
    """Files by header line, for folders whose files order their columns differently.

    A file's header is its first line, found by its place in the file. One row per file reaches
    the driver, which holds the file list anyway.
    """
    first = (
        spark.read.options(**options).text(paths)
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                F.monotonically_increasing_id().alias("line"), "value")
        .where(F.col("start") == 0)
        .groupBy("path").agg(F.min_by("value", "line").alias("header"))
    )
    groups: dict[str, list[str]] = {}
    for row in first.toLocalIterator():
        groups.setdefault(row.header, []).append(row.path)
    return groups


def read_prediction_texts(spark: SparkSession, paths: list[str] | str, mixed_headers: bool = False) -> DataFrame:
    """Required columns as text with ``path``; an absent column is NULL and named in ``absent``."""
    sources = [group for group in header_groups(spark, paths).values()] if mixed_headers else [paths]
    stacked = None
    for source in sources:
        df = _csv(spark, source)
        absent = [c for c in PREDICTION_COLUMNS if c not in df.columns]
        part = df.select(
            F.col("_metadata.file_path").alias("path"),
            F.array(*[F.lit(c) for c in absent]).cast("array<string>").alias("absent"),
            *[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in PREDICTION_COLUMNS],
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


def read_predictions(spark: SparkSession, paths: list[str] | str, mixed_headers: bool = False) -> DataFrame:
    """Typed predictions with the experiment keys taken from the file name.

    ``faulty`` marks rows with a number or time that cannot be parsed; files whose name does not
    match are left out. Extra columns are ignored.
    """
    texts = read_prediction_texts(spark, paths, mixed_headers)
    named = texts.withColumn("named", parse_file_name(base_name(F.url_decode("path"))))
    faulty = _is_bad_number(F.col("y_true")) | _is_bad_number(F.col("y_pred")) | _is_bad_time(F.col("time"))
    return named.where(F.col("named").isNotNull()).select(
        *[F.col(f"named.{k}").alias(k) for k in EXPERIMENT],
        parse_number(F.col("y_true")).alias("y_true"), parse_number(F.col("y_pred")).alias("y_pred"),
        "env", "site_id", parse_time(F.col("time")).alias("time"),
        (faulty | (F.size("absent") > 0)).alias("faulty"), "path",
    )


def unreadable_files(spark: SparkSession, paths: list[str] | str, mixed_headers: bool = False) -> DataFrame:
    """Files that miss a required column or hold values that cannot be parsed, with the reason."""
    texts = read_prediction_texts(spark, paths, mixed_headers)
    per_file = texts.groupBy("path").agg(
        F.max("absent").alias("absent"),
        F.count_if(_is_bad_number(F.col("y_true")) | _is_bad_number(F.col("y_pred"))).alias("bad_numbers"),
        F.count_if(_is_bad_time(F.col("time"))).alias("bad_times"),
    )
    return per_file.select("path", F.concat_ws(
        "; ",
        F.when(F.size("absent") > 0, F.concat(F.lit("missing columns "), F.array_join("absent", ", "))),
        F.when(F.col("bad_numbers") > 0, F.concat(F.col("bad_numbers"), F.lit(" values are no numbers"))),
        F.when(F.col("bad_times") > 0, F.concat(F.col("bad_times"), F.lit(" times cannot be parsed"))),
    ).alias("problem")).where(F.col("problem") != "")


_METRIC_COLUMNS = ["target", "setting", "model", "scale", "env", "n_samples", *METRICS]
_METRIC_FILES = {"recursiveFileLookup": True, "pathGlobFilter": "*.csv"}


def _complete(header: str) -> bool:
    return set(_METRIC_COLUMNS) <= {c.strip().strip('"') for c in header.split(",")}


def _metric_name() -> Column:
    """Experiment of a metric file: by its own name, or by the folder the sink gives it."""
    folder = F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), "experiment=([^/]+)/[^/]+$", 1)
    return F.coalesce(parse_file_name(F.col("_metadata.file_name")), parse_file_name(F.concat(folder, F.lit(".csv"))))


def read_metric_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Metric CSVs of all submissions in one table; the strategy comes from the name. Files with
    another name or without one of the columns are skipped (``skipped_metric_files`` lists the latter)."""
    table = spark.createDataFrame([], METRICS_SCHEMA)
    for header, files in header_groups(spark, paths, **_METRIC_FILES).items():
        if not _complete(header):
            continue
        named = _csv(spark, files).withColumn("named", _metric_name()).where(F.col("named").isNotNull() & ~F.col("named.is_raw"))
        table = table.unionByName(named.select(
            "target", "setting", "model", F.col("named.val_strategy").alias("val_strategy"), "scale", "env",
            F.col("n_samples").try_cast("bigint").alias("n_samples"),
            *[parse_number(F.col(m)).alias(m) for m in METRICS],
        ))
    return table


def skipped_metric_files(spark: SparkSession, paths: list[str] | str) -> list[str]:
    """Metric files that lack a column."""
    groups = header_groups(spark, paths, **_METRIC_FILES)
    return sorted(path for header, files in groups.items() if not _complete(header) for path in files)


def write_metric_files(metrics: DataFrame, folder: str) -> None:
    """Metrics as CSV that ``read_metric_files`` reads back: one folder per experiment, named after it."""
    name = experiment_name(*[F.col(k) for k in EXPERIMENT])
    metrics.withColumn("experiment", name).write.mode("overwrite").partitionBy("experiment").option("header", True).csv(folder)
