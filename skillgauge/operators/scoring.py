"""Metrics of every experiment, scale and reporting unit."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillgauge.functions import timeparts as tp
from skillgauge.functions.metrics import DEFAULT_METRICS, Metric, metric_columns
from skillgauge.operators import moments
from skillgauge.operators import temporal as ts
from skillgauge.schema import EXPERIMENT, SCALES


@dataclass
class SeriesFrames:
    """The frames a scale can start from; built once and shared by all scales."""

    rows: DataFrame
    keys: Sequence[str] = field(default_factory=lambda: list(EXPERIMENT))
    thresholds: ts.Thresholds = field(default_factory=ts.Thresholds)
    totals: DataFrame | None = None

    def __post_init__(self) -> None:
        by_share = self.thresholds.hour_to_day < 1
        if self.totals is None:
            self.totals = ts.day_totals(self.rows, self.keys, by_share=by_share)
        self._daily: dict[tuple[str, bool], DataFrame] = {}

    def daily(self, unit: str = "env", complete: bool = True) -> DataFrame:
        if (unit, complete) not in self._daily:
            self._daily[unit, complete] = ts.daily_frame(
                self.totals, self.keys, unit, self.thresholds.hour_to_day, complete
            )
        return self._daily[unit, complete]


Scale = Callable[[SeriesFrames], DataFrame]

# A scale returns (keys, unit, y_true, y_pred). The multi-year scales report per site, since a
# single site-year has no multi-year cycle.
DEFAULT_SCALES: dict[str, Scale] = {
    "hourly": lambda s: s.rows.withColumn("unit", F.col("env")).where(F.col("unit").isNotNull()),
    "daily": lambda s: s.daily("env", complete=False),
    "weekly": lambda s: ts.weekly_means(s.daily("env"), s.keys, s.thresholds.weekly),
    "monthly": lambda s: ts.monthly_means(s.daily("env"), s.keys, s.thresholds.monthly),
    "seasonal": lambda s: ts.seasonal_cycle(s.daily("site_id"), s.keys, s.thresholds.seasonal),
    "anom": lambda s: ts.anomalies(s.daily("site_id"), s.keys, s.thresholds.anom),
    "iav": lambda s: ts.interannual(s.daily("site_id"), s.keys, s.thresholds.iav),
    "spatial": lambda s: ts.site_means(s.daily("env"), s.keys, s.thresholds.spatial),
}


# Where each standard scale comes from: the reporting unit and, for scales that group days, the
# period number of a day and whether only valid days count.
UNIT_OF = {"daily": "env", "weekly": "env", "monthly": "env", "spatial": "env",
           "seasonal": "site_id", "anom": "site_id", "iav": "site_id"}
PERIOD_OF: dict[str, tuple[Callable[[], Column], bool]] = {
    "weekly": (lambda: F.unix_date(tp.week_start(F.col("day"))), False),
    "monthly": (lambda: F.year("day") * 12 + F.month("day"), False),
    "seasonal": (lambda: F.dayofyear("day"), True),
    "iav": (lambda: F.year("day"), True),
    "spatial": (lambda: F.year("day"), True),
}


def standard_series(frames: SeriesFrames, scales: Sequence[str]) -> list[tuple[DataFrame, list[str]]]:
    """``(keys, scale, env, y_true, y_pred)`` of the standard scales with count thresholds, in parts, each with the columns
    besides keys, scale and unit by which its rows are spread.

    The same results as the single scale operators with fewer passes: both reporting units travel
    through one daily frame (the unit kind is one more experiment key), the day-level scales are
    one projection of it, and all period-level scales are one group. Everything after the daily
    frame stays in its partitions, the metrics too: a scale has one kind and a unit one slot, so groups that name these as
    well are the same, and need no shuffle.
    """
    keys, limits = [*frames.keys, "kind"], frames.thresholds
    kinds = sorted({UNIT_OF[s] for s in scales if s in UNIT_OF})
    parts = []
    if "hourly" in scales:
        parts.append(frames.rows.where(F.col("env").isNotNull()).select(
            *frames.keys, F.lit("hourly").alias("scale"), "env", "y_true", "y_pred"))
    if kinds:
        by_unit = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("unit")) for k in kinds]))
        totals = frames.totals.withColumn("u", by_unit).select("*", "u.kind", "u.unit").drop("u", "env", "site_id")
        daily = ts.daily_frame(totals, keys, "unit", limits.hour_to_day, complete=False)
        complete = F.col("state") != ts.NULL_PREDICTION
    out = [*keys, "slot", "scale", F.col("unit").alias("env"), "y_true", "y_pred"]

    points = [s for s in ("daily", "anom") if s in scales]
    if points:
        is_daily = F.col("kind") == "env"
        wanted = F.lit(False)
        if "daily" in points:
            wanted = wanted | is_daily
        if "anom" in points:
            wanted = wanted | (~is_daily & complete)
        days = daily.where(wanted).withColumn("doy", F.dayofyear("day"))
        if "anom" in points:
            same_day = W.partitionBy(*keys, "slot", "unit", "doy")
            valid = F.col("valid")
            usual = {c: F.avg(F.when(valid, F.col(c))).over(same_day) for c in ("y_true", "y_pred")}
            enough = F.count_if(valid).over(same_day) >= F.lit(limits.anom)
            days = days.select(
                *keys, "slot", "unit",
                F.when(is_daily, F.col("y_true")).otherwise(F.col("y_true") - F.when(enough, usual["y_true"])).alias("y_true"),
                F.when(is_daily, F.col("y_pred")).otherwise(F.col("y_pred") - usual["y_pred"]).alias("y_pred"),
            )
        parts.append(days.withColumn("scale", F.when(is_daily, "daily").otherwise("anom")).select(*out))

    grouped = [s for s in PERIOD_OF if s in scales]
    if grouped:
        def periods(kind: str) -> Column:
            entries = []
            for s in (g for g in grouped if UNIT_OF[g] == kind):
                number, only_valid = PERIOD_OF[s]
                entry = F.struct(F.lit(s).alias("scale"), number().cast("int").alias("period"))
                entries.append(F.when(F.col("valid"), entry) if only_valid else entry)
            return F.array_compact(F.array(*entries)) if entries else None

        choice = None
        for kind in kinds:
            if periods(kind) is not None:
                test = F.col("kind") == kind
                choice = F.when(test, periods(kind)) if choice is None else choice.when(test, periods(kind))
        least = F.coalesce(*[F.when(F.col("scale") == s, F.lit(float(getattr(limits, s)))) for s in grouped])
        years = W.partitionBy(*keys, "slot", "unit", "scale")
        means = (
            daily.where(complete).withColumn("p", F.explode(choice)).select("*", "p.scale", "p.period")
            .groupBy(*keys, "slot", "unit", "scale", "period")
            .agg(F.count_if("valid").alias("n"), F.avg("y_true").alias("y_true"), F.avg("y_pred").alias("y_pred"))
            .withColumn("y_true", F.when(F.col("n") >= least, F.col("y_true")))
        )
        if {"iav", "spatial"} & set(grouped):
            means = means.select(
                *keys, "slot", "unit", "scale", "y_true", "y_pred",
                F.avg("y_true").over(years).alias("mean_true"), F.avg("y_pred").over(years).alias("mean_pred"),
                F.row_number().over(years.orderBy("period")).alias("place"),
            ).where((F.col("scale") != "spatial") | (F.col("place") == 1))
            for c, m in (("y_true", "mean_true"), ("y_pred", "mean_pred")):
                means = means.withColumn(c, F.when(F.col("scale") == "iav", F.col(c) - F.col(m))
                                         .when(F.col("scale") == "spatial", F.col(m)).otherwise(F.col(c)))
        parts.append(means.select(*out))

    return [(part, [c for c in ("kind", "slot") if c in part.columns]) for part in parts]


def metrics_by_unit(
    series: DataFrame, by: Sequence[str], metrics: dict[str, Metric] | None = None
) -> DataFrame:
    """One row per group with ``n_samples`` (all rows, also incomplete ones) and the metrics."""
    return series.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"),
        *metric_columns(metrics or DEFAULT_METRICS, F.col("y_true"), F.col("y_pred")),
    )


def compute_metrics(
    predictions: DataFrame,
    scales: Sequence[str] | None = None,
    metrics: dict[str, Metric] | None = None,
    thresholds: ts.Thresholds | None = None,
    keys: Sequence[str] = EXPERIMENT,
    registry: dict[str, Scale] | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Metrics of all experiments at all scales in one plan.

    ``predictions`` is a cleaned table (see ``clean_predictions``) that already carries the truth
    to score against. Standard scales are reduced to metrics inside their own partitions; hourly rows and other scales are
    reduced to metric buffers before a closing shuffle. ``totals`` are the
    day totals of the predictions where these are known already.
    """
    registry = registry or DEFAULT_SCALES
    names = list(scales or (SCALES if registry is DEFAULT_SCALES else registry))
    frames = SeriesFrames(predictions, list(keys), thresholds or ts.Thresholds(), totals)
    stacked, scored = None, []
    limits = frames.thresholds
    counts_only = min(limits.weekly, limits.monthly, limits.seasonal, limits.anom, limits.iav, limits.spatial) >= 1
    if registry is DEFAULT_SCALES and counts_only and all(n in registry for n in names):
        scored = [metrics_by_unit(part, [*keys, *spread, "scale", "env"], metrics).drop(*spread) for part, spread in standard_series(frames, names)]
        names = []
    for name in names:
        if name not in registry:
            warnings.warn(f"unknown scale {name!r}; known: {sorted(registry)}", stacklevel=2)
            continue
        part = registry[name](frames).select(
            *keys, F.lit(name).alias("scale"), F.col("unit").alias("env"), "y_true", "y_pred"
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    if stacked is not None:
        scored.append(metrics_by_unit(stacked, [*keys, "scale", "env"], metrics))
    if not scored:
        raise ValueError("no known scale to compute")
    scored = reduce(DataFrame.unionByName, scored)
    leading = [c for c in ["target", "setting", "model", "val_strategy"] if c in keys]
    leading += [c for c in keys if c not in leading] + ["scale", "env", "n_samples"]
    return scored.select(*leading, *[c for c in scored.columns if c not in leading])


def metrics_and_coverage(
    joined: DataFrame, scales: Sequence[str] | None = None, metrics: dict[str, Metric] | None = None,
    thresholds: ts.Thresholds | None = None, registry: dict[str, Scale] | None = None, by_day: bool = False,
    chosen: Callable[[DataFrame], DataFrame] | None = None, store_totals: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(metrics, coverage)`` of rows joined with the truth. The join is evaluated once and stored, and serves all
    scales and the coverage. Rows are stored site by site, so that tasks which read them have few groups each, and day totals are
    stored as well: what the shuffles of both take goes before the next one begins.

    With ``by_day``, what is stored are site-days with their error moments (``moments``) instead of rows: for series with
    many rows a day, built-in scales and metrics, and thresholds by count. Otherwise it is without effect.

    ``chosen`` gives from the coverage a small table of the experiments (or of some of their keys) whose metrics are wanted; those of
    others are not computed. Without ``store_totals`` nothing but the rows is stored before the metrics are read.
    """
    from skillgauge.operators.truth import COMBO, coverage
    from skillgauge.sources.stores import stage

    limits, own = thresholds or ts.Thresholds(), metrics or DEFAULT_METRICS
    names = list(scales or SCALES)
    by_count = min(limits.hour_to_day, limits.weekly, limits.monthly, limits.seasonal, limits.anom, limits.iav, limits.spatial) >= 1

    def only(table: DataFrame, found: DataFrame) -> DataFrame:
        return table if chosen is None else table.join(keys := chosen(found), keys.columns, "left_semi")

    if not by_day or registry is not None or not by_count or any(DEFAULT_METRICS.get(m) is not f for m, f in own.items()) or not set(names) <= set(SCALES):
        rows = stage(joined.hint("rebalance", *[F.col(c) for c in (*COMBO, "site_id")]), "scored-rows")
        found = coverage(rows)
        rows, totals = only(rows, found), None
        if store_totals and (registry is not None or set(names) - {"hourly"}):
            totals = ts.day_totals(rows, by_share=limits.hour_to_day < 1)
            totals = stage(totals.sortWithinPartitions(*EXPERIMENT, "site_id", "env", "day"), "day-totals")  # like rows together take less room
        return compute_metrics(rows, scales, metrics, thresholds, registry=registry, totals=totals), found
    every = stage(moments.site_days(joined), "site-days")
    found = moments.coverage_of(every)
    days = only(every, found)
    parts = [moments.hourly_metrics(days, EXPERIMENT, list(own))] if "hourly" in names else []
    if rest := [s for s in names if s != "hourly"]:
        parts.append(compute_metrics(joined, rest, metrics, thresholds, totals=days))
    return parts[-1] if len(parts) == 1 else parts[1].unionByName(parts[0]), found


def sample_sizes(metrics: DataFrame, keys: Sequence[str] = EXPERIMENT) -> DataFrame:
    """Groups per scale and the spread of their sizes."""
    return metrics.groupBy(*keys, "scale").agg(
        F.count(F.lit(1)).alias("groups"),
        F.min("n_samples").alias("min_samples"),
        F.avg("n_samples").alias("mean_samples"),
        F.max("n_samples").alias("max_samples"),
    )
