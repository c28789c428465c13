"""Temporal-scale operators: hourly rows to daily, weekly, monthly, yearly, seasonal cycle,
anomalies, inter-annual variability and site means.

How the work is laid out
------------------------
1. ``day_totals`` reduces raw rows to one row per (experiment, env, site, day) with mergeable
   sums. It is the only shuffle fed by raw rows, and it is combined before it is written.
2. ``daily_frame`` spreads those day rows by (experiment, slot), where ``slot`` is a hash of the
   reporting unit (``env`` or ``site_id``). Every later step groups by keys that contain
   (experiment, slot), so weeks, months, years, seasonal cycles and anomalies need no further
   shuffle. One experiment is split over up to ``SLOTS`` tasks, and one unit holds at most one
   row per calendar day, so no task or window is fed without bound.
3. Facts about a whole experiment (is the input daily already, does a day lack its prediction)
   are reduced per (experiment, slot) first and then over at most ``SLOTS`` rows per experiment.

``keys`` are the experiment columns; the operators handle all experiments of a frame at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillgauge.functions import timeparts as tp
from skillgauge.functions.numeric import nan_to_null, ratio
from skillgauge.schema import EXPERIMENT

SLOTS = 1024  # a power of two

# States of an experiment after daily aggregation.
OK, NO_TRUTH, NULL_PREDICTION = "ok", "no_truth", "null_prediction"


@dataclass(frozen=True)
class Thresholds:
    """Least number (or, below 1, share) of valid parts a period needs to keep its truth."""

    hour_to_day: float = 12
    weekly: float = 4
    monthly: float = 15
    yearly: float = 183
    seasonal: float = 2
    anom: float = 2
    iav: float = 183
    spatial: float = 1


def _present(yt: Column, yp: Column) -> Column:
    return yt.isNotNull() & yp.isNotNull()


def _valid(mask: Column | None) -> Column:
    return F.lit(True) if mask is None else F.coalesce(mask, F.lit(True))


# --------------------------------------------------------------------- thresholds


def threshold_mean(
    df: DataFrame,
    by: Sequence[str],
    minimum: float,
    method: str = "mean",
    only_valid: bool = False,
) -> DataFrame:
    """Group mean (or exact median) of both series; the truth is dropped from thin groups.

    ``minimum >= 1`` counts ``valid`` rows. ``minimum < 1`` compares the share of absolute truth
    carried by valid rows; an all-zero group has no share and is kept. ``only_valid`` leaves
    invalid rows out of the means themselves. Predictions are never dropped.
    """
    average = F.median if method == "median" else F.avg
    valid = F.col("valid")
    if minimum < 1:
        if only_valid:
            raise ValueError("a share threshold cannot be combined with masking before the mean")
        size = F.abs(F.col("y_true"))
        share = ratio(
            F.coalesce(F.sum(F.when(valid, size)), F.lit(0.0)),
            F.coalesce(F.sum(size), F.lit(0.0)),
        )
        thin = F.coalesce(share < F.lit(float(minimum)), F.lit(False))
    else:
        thin = F.count_if(valid) < F.lit(minimum)
    series = {
        name: F.when(valid, F.col(name)) if only_valid else F.col(name)
        for name in ("y_true", "y_pred")
    }
    return (
        df.groupBy(*by)
        .agg(
            thin.alias("thin"),
            average(series["y_true"]).alias("y_true"),
            average(series["y_pred"]).alias("y_pred"),
        )
        .select(
            *by,
            nan_to_null(F.when(~F.col("thin"), F.col("y_true"))).alias("y_true"),
            nan_to_null(F.col("y_pred")).alias("y_pred"),
        )
    )


# --------------------------------------------------------------------- daily base


def day_totals(
    df: DataFrame,
    keys: Sequence[str] = EXPERIMENT,
    units: Sequence[str] = ("env", "site_id"),
    mask: Column | None = None,
    by_share: bool = False,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per (experiment, units, day) with sums that can be merged further, and ``extra`` aggregates
    of y_true and y_pred."""
    rows = df.select(
        *keys, *units, "time", "y_true", "y_pred",
        tp.day_of(F.col("time")).alias("day"),
        _valid(mask).alias("valid"),
    )
    size = F.abs(F.col("y_true"))
    share_columns = [
        F.sum(F.when(F.col("valid"), size)).alias("valid_size"),
        F.sum(size).alias("size"),
    ] if by_share else []
    return rows.groupBy(*keys, *units, "day").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("valid").alias("n_valid"),
        F.min("time").alias("first_time"),
        F.sum("y_true").alias("true_sum"),
        F.count("y_true").alias("true_n"),
        F.sum("y_pred").alias("pred_sum"),
        F.count("y_pred").alias("pred_n"),
        *share_columns, *extra,
    )


def _unit_days(totals: DataFrame, keys: Sequence[str], unit: str, hour_to_day: float) -> DataFrame:
    """Day rows of one unit, spread by (experiment, slot)."""
    by_share = hour_to_day < 1
    days = (
        totals.withColumn("slot", F.xxhash64(unit).bitwiseAND(F.lit(SLOTS - 1)))
        .repartition(*keys, "slot")
        .groupBy(*keys, "slot", F.col(unit).alias("unit"), "day")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_valid").alias("n_valid"),
            F.min("first_time").alias("first_time"),
            nan_to_null(ratio(F.sum("true_sum"), F.sum("true_n"))).alias("y_true"),
            nan_to_null(ratio(F.sum("pred_sum"), F.sum("pred_n"))).alias("y_pred"),
            # Tested on an aggregate, so that the test stays above this group and the
            # frames of both units share the shuffle below.
            F.bool_and(F.col(unit).isNotNull() & F.col("day").isNotNull()).alias("keyed"),
            *([
                ratio(
                    F.coalesce(F.sum("valid_size"), F.lit(0.0)),
                    F.coalesce(F.sum("size"), F.lit(0.0)),
                ).alias("share")
            ] if by_share else []),
        )
        .where("keyed")
    )
    thin = (
        F.coalesce(F.col("share") < F.lit(float(hour_to_day)), F.lit(False))
        if by_share
        else F.col("n_valid") < F.lit(hour_to_day)
    )
    return days.withColumn("thin", thin).drop("share", "keyed")


def _experiment_state(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per (experiment, slot): is the whole experiment daily already, and its state."""
    per_slot = days.groupBy(*keys, "slot").agg(
        F.max("n_rows").alias("rows"),
        F.count("y_true").alias("truth_days"),
        F.count_if(F.col("y_pred").isNull()).alias("null_days"),
        F.count_if(F.col("y_pred").isNull() & (F.col("n_valid") > 0)).alias("null_valid_days"),
        F.count(F.when(~F.col("thin"), F.col("y_true"))).alias("kept_days"),
    )
    whole = W.partitionBy(*keys)  # at most SLOTS rows
    daily = F.max("rows").over(whole) <= 1
    nulls = F.when(daily, F.sum("null_valid_days").over(whole)).otherwise(F.sum("null_days").over(whole))
    truth = F.when(daily, F.sum("truth_days").over(whole)).otherwise(F.sum("kept_days").over(whole))
    return per_slot.select(
        *keys, "slot",
        daily.alias("daily_input"),
        F.when(nulls > 0, NULL_PREDICTION).when(truth == 0, NO_TRUTH).otherwise(OK).alias("state"),
    )


def daily_frame(
    totals: DataFrame,
    keys: Sequence[str] = EXPERIMENT,
    unit: str = "env",
    hour_to_day: float = 12,
    complete: bool = True,
) -> DataFrame:
    """Daily means per unit: ``(keys, slot, unit, day, time, y_true, y_pred, valid, state)``.

    A day with fewer than ``hour_to_day`` valid rows loses its truth. An experiment whose every
    (unit, day) holds at most one row is daily already: its valid rows pass unchanged. With
    ``complete`` an experiment that misses a daily prediction is left out, as no coarser scale
    is defined for it.
    """
    days = _unit_days(totals, keys, unit, hour_to_day)
    # One state row per (experiment, slot): days stay where they are, the other side is small
    # in every task, and nothing passes through the driver.
    state = _experiment_state(days, keys).hint("shuffle_hash")
    # The longer list keeps every experiment; it is a test all the same, so that both
    # variants read the same columns and share their shuffle.
    wanted = [OK, NO_TRUTH] if complete else [OK, NO_TRUTH, NULL_PREDICTION]
    daily_input = F.col("daily_input")
    return (
        days.join(state, [*keys, "slot"])
        .where(~daily_input | (F.col("n_valid") > 0))
        .where(F.col("n_rows") > 0)  # always; the state reads it too, and so both sides share one shuffle
        .where(F.col("state").isin(wanted))
        .select(
            *keys, "slot", "unit", "day",
            F.when(daily_input, F.col("first_time")).otherwise(tp.as_time(F.col("day"))).alias("time"),
            F.when(daily_input | ~F.col("thin"), F.col("y_true")).alias("y_true"),
            "y_pred",
            "state",
        )
        .withColumn("valid", _present(F.col("y_true"), F.col("y_pred")))
    )


def scale_state(totals: DataFrame, keys: Sequence[str] = EXPERIMENT, hour_to_day: float = 12) -> DataFrame:
    """QA table: state of every experiment for the ``env`` scales and the ``site_id`` scales."""
    frames = [
        _experiment_state(_unit_days(totals, keys, unit, hour_to_day), keys)
        .groupBy(*keys)
        .agg(F.bool_and("daily_input").alias("daily_input"), F.max("state").alias("state"))
        .withColumn("unit", F.lit(unit))
        for unit in ("env", "site_id")
    ]
    return frames[0].unionByName(frames[1])


# --------------------------------------------------------------------- from daily


def weekly_means(daily: DataFrame, keys: Sequence[str] = EXPERIMENT, minimum: float = 4) -> DataFrame:
    """Monday-based weeks over all days; the time is the Thursday."""
    weeks = daily.withColumn("week", tp.week_start(F.col("day")))
    means = threshold_mean(weeks, [*keys, "slot", "unit", "week"], minimum)
    return means.withColumn("time", tp.mid_week(F.col("week"))).drop("week")


def monthly_means(daily: DataFrame, keys: Sequence[str] = EXPERIMENT, minimum: float = 15) -> DataFrame:
    months = daily.withColumn("month", tp.month_start(F.col("day")))
    means = threshold_mean(months, [*keys, "slot", "unit", "month"], minimum)
    return means.withColumn("time", tp.mid_month(F.col("month"))).drop("month")


def yearly_means(daily: DataFrame, keys: Sequence[str] = EXPERIMENT, minimum: float = 183) -> DataFrame:
    years = daily.withColumn("year", F.year("day"))
    means = threshold_mean(years, [*keys, "slot", "unit", "year"], minimum)
    return means.withColumn("time", tp.mid_year(F.col("year"))).drop("year")


def seasonal_cycle(
    daily: DataFrame, keys: Sequence[str] = EXPERIMENT, minimum: float = 2, method: str = "mean",
    keep_empty: bool = False,
) -> DataFrame:
    """Mean (or median) per day of year over valid days; 366 is its own day.

    Days of year without a valid day do not appear unless ``keep_empty``.
    """
    days = daily if keep_empty else daily.where("valid")
    days = days.withColumn("doy", F.dayofyear("day"))
    return threshold_mean(days, [*keys, "slot", "unit", "doy"], minimum, method, only_valid=True)


def anomalies(
    daily: DataFrame, keys: Sequence[str] = EXPERIMENT, minimum: float = 2, method: str = "mean"
) -> DataFrame:
    """Each day minus the unit's seasonal cycle; every day is kept.

    A window over (unit, day of year) holds one row per year and needs no join.
    """
    if minimum < 1:
        raise ValueError("a share threshold cannot be combined with masking before the mean")
    same_day = W.partitionBy(*keys, "slot", "unit", "doy")
    average = F.median if method == "median" else F.avg
    valid = F.col("valid")
    cycle = lambda name: average(F.when(valid, F.col(name))).over(same_day)
    years = F.count_if(valid).over(same_day)
    return daily.withColumn("doy", F.dayofyear("day")).select(
        *keys, "slot", "unit", "time",
        (F.col("y_true") - F.when(years >= F.lit(minimum), cycle("y_true"))).alias("y_true"),
        (F.col("y_pred") - cycle("y_pred")).alias("y_pred"),
    )


def interannual(daily: DataFrame, keys: Sequence[str] = EXPERIMENT, minimum: float = 183) -> DataFrame:
    """Yearly means of valid days minus their mean over the years of the unit."""
    yearly = yearly_means(daily.where("valid"), keys, minimum)
    years = W.partitionBy(*keys, "slot", "unit")
    return yearly.select(
        *keys, "slot", "unit", "time",
        (F.col("y_true") - F.avg("y_true").over(years)).alias("y_true"),
        (F.col("y_pred") - F.avg("y_pred").over(years)).alias("y_pred"),
    )


def site_means(daily: DataFrame, keys: Sequence[str] = EXPERIMENT, minimum: float = 1) -> DataFrame:
    """Unweighted mean of the yearly means of valid days."""
    yearly = yearly_means(daily.where("valid"), keys, minimum)
    return yearly.groupBy(*keys, "slot", "unit").agg(
        F.avg("y_true").alias("y_true"), F.avg("y_pred").alias("y_pred"),
    )


# --------------------------------------------------------------------- one-call operators


def hourly(df: DataFrame, mask: Column | None = None) -> DataFrame:
    """The valid raw rows."""
    return df if mask is None else df.where(_valid(mask))


def _daily_of(df, keys, unit, mask, hour_to_day, complete=True):
    totals = day_totals(df, keys, (unit,), mask, by_share=hour_to_day < 1)
    return daily_frame(totals, keys, unit, hour_to_day, complete)


def _as(frame: DataFrame, keys: Sequence[str], unit: str, *columns: str) -> DataFrame:
    return frame.select(*keys, F.col("unit").alias(unit), *columns, "y_true", "y_pred")


def aggregate_daily(df, mask=None, minimum=12, keys=EXPERIMENT, unit="env"):
    return _as(_daily_of(df, keys, unit, mask, minimum, complete=False), keys, unit, "time")


def aggregate_weekly(df, mask=None, minimum=4, hour_to_day=12, keys=EXPERIMENT, unit="env"):
    return _as(weekly_means(_daily_of(df, keys, unit, mask, hour_to_day), keys, minimum), keys, unit, "time")


def aggregate_monthly(df, mask=None, minimum=15, hour_to_day=12, keys=EXPERIMENT, unit="env"):
    return _as(monthly_means(_daily_of(df, keys, unit, mask, hour_to_day), keys, minimum), keys, unit, "time")


def aggregate_yearly(df, mask=None, minimum=183, hour_to_day=12, keys=EXPERIMENT, unit="env"):
    return _as(yearly_means(_daily_of(df, keys, unit, mask, hour_to_day), keys, minimum), keys, unit, "time")


def aggregate_seasonal(df, mask=None, minimum=2, hour_to_day=12, method="mean", keys=EXPERIMENT, unit="env"):
    daily = _daily_of(df, keys, unit, mask, hour_to_day)
    return _as(seasonal_cycle(daily, keys, minimum, method), keys, unit, "doy")


def compute_msc(df, mask=None, minimum=2, hour_to_day=12, method="mean", keys=EXPERIMENT, unit="env"):
    """Seasonal cycle with one row for every day of year that has any day, valid or not."""
    daily = _daily_of(df, keys, unit, mask, hour_to_day)
    return _as(seasonal_cycle(daily, keys, minimum, method, keep_empty=True), keys, unit, "doy")


def aggregate_anomaly(df, mask=None, minimum=2, hour_to_day=12, method="mean", keys=EXPERIMENT, unit="env"):
    daily = _daily_of(df, keys, unit, mask, hour_to_day)
    return _as(anomalies(daily, keys, minimum, method), keys, unit, "time")


def aggregate_iav(df, mask=None, minimum=183, hour_to_day=12, keys=EXPERIMENT, unit="env"):
    return _as(interannual(_daily_of(df, keys, unit, mask, hour_to_day), keys, minimum), keys, unit, "time")


def aggregate_spatial(df, mask=None, hour_to_day=12, keys=EXPERIMENT, unit="env"):
    return _as(site_means(_daily_of(df, keys, unit, mask, hour_to_day), keys), keys, unit)
