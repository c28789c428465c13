"""Ingest rules: typed columns, NaN to NULL, defaults for optional columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgauge.functions.numeric import nan_to_null
from skillgauge.schema import EXPERIMENT


def clean_predictions(df: DataFrame) -> DataFrame:
    """Bring a prediction table into the working shape.

    NaN becomes NULL, ``time`` is zone-free, ``site_id`` falls back to ``env`` and
    ``val_strategy`` to ``mean``. Columns outside the working shape are dropped, so the
    scan below reads only what is used.
    """
    if "site_id" not in df.columns:
        df = df.withColumn("site_id", F.col("env"))
    if "val_strategy" not in df.columns:
        df = df.withColumn("val_strategy", F.lit("mean"))
    return df.select(
        *EXPERIMENT,
        F.col("env").cast("string").alias("env"),
        F.col("site_id").cast("string").alias("site_id"),
        F.col("time").cast("timestamp_ntz").alias("time"),
        nan_to_null(F.col("y_true").cast("double")).alias("y_true"),
        nan_to_null(F.col("y_pred").cast("double")).alias("y_pred"),
    )
