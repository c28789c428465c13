"""Registry documents as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_STREAM_SCHEMA = "value string"


def read_registry(spark: SparkSession, folder: str, one_per_file: bool = True) -> DataFrame:
    """``(path, doc)``: a JSON document per file, or one per line."""
    return spark.read.options(wholetext=one_per_file, recursiveFileLookup=True, pathGlobFilter="*.json").text(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc")
    )


def stream_registry(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Documents as they arrive, one per line of any new file; a batch takes ``max_files`` files at most
    and leaves the others to the next."""
    return spark.readStream.schema(REGISTRY_STREAM_SCHEMA).option("maxFilesPerTrigger", max_files).text(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc")
    )
