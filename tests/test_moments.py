"""Metrics and coverage from site-days against those from rows."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skillgauge.operators import leaderboard as lb, moments, scoring, truth as tr
from skillgauge.operators import temporal as ts
from skillgauge.schema import EXPERIMENT, METRICS
from tests.helpers import series

LIMITS = ts.Thresholds(hour_to_day=2, weekly=2, monthly=2, seasonal=1, anom=1, iav=2, spatial=2)


def rows(spark):
    rng = random.Random(4)
    out = []
    for env, site, kind in [("a", "s1", "plain"), ("a", "s2", "plain"), ("b", "s1", "flat"), ("c", "s3", "far"), (None, "s4", "plain"), ("d", "s5", "flat prediction"), ("e", "s6", "none")]:
        for h in range(0, 24 * 9, 5):
            y = {"flat": 0.1, "far": 1e6 + rng.random(), "none": None}.get(kind, rng.gauss(0, 3))
            p = 0.5 if kind == "flat prediction" else rng.gauss(0, 3) + (1e6 if kind == "far" else 0)
            out.append((env, site, datetime(2020, 1, 1) + timedelta(hours=h), None if rng.random() < 0.05 else y, None if rng.random() < 0.05 else p))
    return series(spark, out)


def table(df):
    return {tuple(r[k] for k in (*EXPERIMENT, "scale", "env")): (r.n_samples, *[r[m] for m in METRICS]) for r in df.collect()}


def assert_close(got, want):
    assert got.keys() == want.keys()
    for key, values in want.items():
        for x, y in zip(got[key], values):
            assert (x is None) == (y is None) and (y is None or math.isclose(x, y, rel_tol=1e-6, abs_tol=1e-9)), (key, got[key], values)


def test_metrics_of_days_are_those_of_rows(spark):
    joined = rows(spark)
    got, found = scoring.metrics_and_coverage(joined, thresholds=LIMITS, by_day=True)
    got, want = table(got), table(scoring.compute_metrics(joined, thresholds=LIMITS))
    assert len({k[4] for k in got}) == 8
    assert_close(got, want)
    assert found.drop("covered").collect() == tr.coverage(joined).drop("covered").collect()
    assert got[("time-split", "GPP", "demo", "mean", "hourly", "b")][4] is None  # flat truth: no NSE


def test_stored_rows_give_the_same(spark):
    joined = rows(spark)
    got, found = scoring.metrics_and_coverage(joined, thresholds=LIMITS)
    assert_close(table(got), table(scoring.compute_metrics(joined, thresholds=LIMITS)))
    assert found.collect() == tr.coverage(joined).collect()


def test_choice_of_scales_and_metrics(spark):
    only, _ = scoring.metrics_and_coverage(rows(spark), scales=["hourly"], metrics={"nse": scoring.DEFAULT_METRICS["nse"]}, thresholds=LIMITS, by_day=True)
    assert only.columns[-2:] == ["n_samples", "nse"] and {r.scale for r in only.collect()} == {"hourly"}
    none, _ = scoring.metrics_and_coverage(rows(spark), scales=["weekly"], thresholds=LIMITS, by_day=True)
    assert {r.scale for r in none.collect()} == {"weekly"}


def test_other_metrics_are_taken_from_rows(spark):
    worst = {"worst": lambda yt, yp: F.max(F.abs(yp - yt))}
    got, found = scoring.metrics_and_coverage(rows(spark), scales=["hourly"], metrics=worst, thresholds=LIMITS, by_day=True)
    assert "worst" in got.columns and found.count() == 1


@pytest.mark.parametrize("change", [lambda y: y + 1e-12, lambda y: F.lit(None).cast("double"), lambda y: F.lit(float("nan"))])
def test_fingerprint_shows_one_changed_value(spark, change):
    truth = spark.range(200).select(
        F.when(F.col("id") % 2 == 0, "TA40").otherwise("time-split").alias("setting"), F.lit("ET").alias("target"), F.col("id").cast("string").alias("site_id"),
        F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz").alias("time"), (F.col("id") / 7).alias("y_true"))
    recorded = tr.full_manifest(truth)
    assert all(r.matches for r in tr.verify_manifest(truth.repartition(7), recorded).collect())
    spoilt = truth.withColumn("y_true", F.when(F.col("site_id") == "11", change(F.col("y_true"))).otherwise(F.col("y_true")))
    assert {r.setting: r.matches for r in tr.verify_manifest(spoilt, recorded).collect()} == {"TA40": True, "time-split": False}
    assert all(r.matches for r in tr.verify_manifest(spoilt, recorded.withColumn("fingerprint", F.lit(None).cast("string"))).collect())  # an older manifest
    assert {r.total_rows for r in recorded.collect()} == {200}


def test_living_columns(spark):
    cells = spark.createDataFrame(
        [("GPP", "m", "mean", "TA40", "weekly", 1.0), ("GPP", "m", "mean", "TA40", "hourly", None), ("GPP", "n", "mean", "time-split", "iav", 2.0),
         ("GPP", "n", "mean", "TA40", "made up", 2.0)], "target string, model string, val_strategy string, setting string, scale string, value double")
    living = lb.living_columns(cells)
    assert living == [("time-split", "iav"), ("TA40", "weekly"), ("TA40", "made up")]
    assert lb.wide(cells, living).columns[3:] == ["time-split_iav", "TA40_weekly", "TA40_made up"]
    assert lb.living_columns(cells.where("false")) == []
