"""Recomputed against recorded metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgauge.functions.numeric import INFINITY, is_close
from skillgauge.schema import EXPERIMENT

# Ratio metrics are left out: they are unstable where the mean observation is near zero.
COMPARED = ["mse", "rmse", "mae", "nse", "r2_score", "bias"]
RTOL, ATOL, SIGNIFICANT = 1e-6, 1e-9, 1e-8


def compare_metrics(
    new: DataFrame, recorded: DataFrame, keys: Sequence[str] = EXPERIMENT, metrics: Sequence[str] = COMPARED
) -> DataFrame:
    """Per experiment and metric: compared cells, mismatches (values out of tolerance plus cells
    missing on one side only) and the worst relative difference over significant cells."""
    join_keys = [*keys, "scale", "env"]
    sides = new.select(*join_keys, *[F.col(m).alias(f"{m}_new") for m in metrics]).join(
        recorded.select(*join_keys, *[F.col(m).alias(f"{m}_ref") for m in metrics]), join_keys
    )
    pairs = F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"{m}_new").alias("a"), F.col(f"{m}_ref").alias("b")) for m in metrics
    ]))
    a, b = F.col("a"), F.col("b")
    fin = lambda c: F.coalesce(F.abs(c) < F.lit(INFINITY), F.lit(False))
    both = fin(a) & fin(b)
    return sides.select(*keys, pairs).groupBy(*keys, "metric").agg(
        F.count(F.lit(1)).alias("cells"),
        (F.count_if(fin(a) != fin(b)) + F.count_if(both & ~is_close(a, b, RTOL, ATOL))).alias("mismatches"),
        F.coalesce(
            F.max(F.when(both & (F.abs(b) > SIGNIFICANT), F.abs(a - b) / F.nullif(F.abs(b), F.lit(0.0)))), F.lit(0.0)
        ).alias("worst_relative"),
    )
