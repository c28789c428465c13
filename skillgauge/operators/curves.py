"""Data behind the comparison curves: metric by setting, distribution and quantile curves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.functions.numeric import ratio
from skillgauge.operators.leaderboard import QUANTILES
from skillgauge.operators.ranking import exact_quantile, value_ranks
from skillgauge.schema import HIGHER_IS_BETTER, LEADERBOARD_SCALES, MODEL_ORDER, SETTINGS_ORDER, listed_position

CURVE = ["target", "setting", "scale", "model", "val_strategy"]
_CHUNK = 100_000


def is_higher_better(metric: str) -> bool:
    return metric.lower() in HIGHER_IS_BETTER


def metric_by_setting(
    metrics: DataFrame, metric: str = "rmse", agg: str | Callable[[Column], Column] = "median",
    scales: list[str] | None = None,
) -> DataFrame:
    """One value per (target, scale, setting, model, strategy), with the plotting order of settings and models."""
    rows = metrics.where(F.col("scale").isin(scales or LEADERBOARD_SCALES))
    if isinstance(agg, str) and agg in QUANTILES:
        values = exact_quantile(rows, CURVE, metric, QUANTILES[agg], "value")
    else:
        build = getattr(F, agg) if isinstance(agg, str) else agg
        values = rows.groupBy(*CURVE).agg(build(F.col(metric)).alias("value"))
    return values.withColumn("setting_order", listed_position(F.col("setting"), SETTINGS_ORDER)).withColumn(
        "model_order", listed_position(F.col("model"), MODEL_ORDER)
    )


def cdf_curve(metrics: DataFrame, metric: str = "rmse", scales: list[str] | None = None) -> DataFrame:
    """Sorted values of a metric against evenly spaced shares from 0 to 1, per entry and panel.

    Sorted best first: descending where higher is better. A single value has share 0. A value
    held by many rows is expanded in chunks spread over tasks.
    """
    rows = metrics if scales is None else metrics.where(F.col("scale").isin(scales))
    ranks = value_ranks(rows, CURVE, metric, descending=is_higher_better(metric))
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / _CHUNK))
    spread = ranks.withColumn("chunk", F.explode(chunks)).repartition(*CURVE, metric, "chunk")
    start = F.col("first_rank") + F.col("chunk") * _CHUNK
    end = F.least(start + (_CHUNK - 1), F.col("first_rank") + F.col("copies") - 1)
    return spread.withColumn("rank", F.explode(F.sequence(start, end))).select(
        *CURVE, F.col(metric).alias("value"), "rank",
        F.coalesce(ratio(F.col("rank").cast("double"), (F.col("total") - 1).cast("double")), F.lit(0.0)).alias("share"),
    )


def quantile_curve(metrics: DataFrame, metric: str = "rmse", scales: list[str] | None = None) -> DataFrame:
    """The same points with the axes swapped: value as a function of the share."""
    points = cdf_curve(metrics, metric, scales)
    return points.select(*CURVE, "rank", F.col("share").alias("x"), F.col("value").alias("y"))


def axis_bound(metrics: DataFrame, metric: str = "rmse") -> DataFrame:
    """Largest value per (target, scale)."""
    return metrics.groupBy("target", "scale").agg(F.max(metric).alias("upper"))
