"""File discovery: names, sizes and content hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.functions.naming import base_name, parse_file_name


def _binary(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(folder)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``(path, filename, bytes)``; the content column is pruned, so no file is read."""
    return _binary(spark, folder, pattern).select(
        "path", base_name(F.col("path")).alias("filename"), F.col("length").alias("bytes")
    )


def hash_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``(path, bytes, sha256)``; one file is one row, so it must fit a task (2 GB at most)."""
    return _binary(spark, folder, pattern).select(
        "path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")
    )


def find_experiments(files: DataFrame) -> DataFrame:
    """Raw prediction files of a listing with their experiment keys."""
    return (
        files.where(F.col("filename").endswith("_predictions.csv"))
        .withColumn("named", parse_file_name(F.col("filename")))
        .where(F.col("named").isNotNull())
        .select("named.setting", "named.target", "named.model", "named.val_strategy", "path", "filename", "bytes")
    )
