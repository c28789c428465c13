from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skillgauge.operators import temporal as ts
from skillgauge.operators.scoring import DEFAULT_SCALES, compute_metrics
from tests.helpers import EXP, by, days, hours, series


def test_thin_day_loses_truth_but_keeps_prediction(spark):
    df = series(spark, hours("a", "2020-06-01", 24, 2, 3) + hours("a", "2020-06-02", 5, 2, 7))
    out = by(ts.aggregate_daily(df), "time")
    assert out[datetime(2020, 6, 1)].y_true == 2.0
    assert out[datetime(2020, 6, 2)].y_true is None and out[datetime(2020, 6, 2)].y_pred == 7.0
    m = compute_metrics(df, scales=["daily"]).collect()[0]
    assert m.n_samples == 2 and m.mse == 1.0


def test_daily_input_passes_unchanged(spark):
    df = series(spark, days("a", "2020-01-01", 3, 1, 2))
    out = ts.aggregate_daily(df).collect()
    assert all(r.time.hour == 12 and r.y_true == 1.0 for r in out)


def test_one_double_day_turns_the_hour_rule_on_for_all(spark):
    rows = days("a", "2020-01-01", 3, 1, 2) + hours("b", "2020-01-01", 2, 1, 2)
    out = ts.aggregate_daily(series(spark, rows)).collect()
    assert len(out) == 4 and all(r.y_true is None and r.time.hour == 0 for r in out)


def test_daily_rule_is_decided_per_experiment(spark):
    one = series(spark, days("a", "2020-01-01", 2, 1, 2))
    two = series(spark, hours("a", "2020-01-01", 2, 1, 2), exp=(*EXP[:2], "other", "mean"))
    out = by(ts.aggregate_daily(one.unionByName(two)), "model", "time")
    assert out["demo", datetime(2020, 1, 1, 12)].y_true == 1.0
    assert out["other", datetime(2020, 1, 1)].y_true is None


def test_mask_drops_rows_of_daily_input_and_counts_hours(spark):
    daily = series(spark, days("a", "2020-01-01", 4, lambda t: t.day, 0))
    assert ts.aggregate_daily(daily, F.col("y_true") > 2).count() == 2
    hourly = series(spark, hours("a", "2020-01-01", 24, 1, 2) + hours("a", "2020-01-02", 24, 9, 2))
    out = by(ts.aggregate_daily(hourly, F.col("y_true") < 5), "time")
    assert out[datetime(2020, 1, 1)].y_true == 1.0 and out[datetime(2020, 1, 2)].y_true is None


def test_week_averages_predictions_over_days_without_truth(spark):
    rows = []
    for i in range(7):  # Monday 2020-06-01 to Sunday
        rows += hours("a", f"2020-06-0{i + 1}", 24, 5 if i < 5 else None, i)
    df = series(spark, rows)
    week = ts.aggregate_weekly(df).collect()
    assert len(week) == 1
    assert week[0].y_true == 5.0 and week[0].y_pred == 3.0 and week[0].time == datetime(2020, 6, 4)
    site = ts.aggregate_spatial(df).collect()[0]
    assert site.y_pred == 2.0  # five valid days only


def test_thin_week_and_month(spark):
    df = series(spark, days("a", "2020-06-01", 3, 1, 2))
    assert ts.aggregate_weekly(df).collect()[0].y_true is None
    month = ts.aggregate_monthly(df).collect()[0]
    assert month.y_true is None and month.y_pred == 2.0 and month.time == datetime(2020, 6, 15)
    assert ts.aggregate_monthly(df, minimum=3).collect()[0].y_true == 1.0


def test_leap_day_has_too_few_years(spark):
    df = series(spark, days("a", "2019-01-01", 365 + 366 + 365, 4, 5))
    out = by(ts.aggregate_seasonal(df), "doy")
    assert len(out) == 366
    assert out[366].y_true is None and out[366].y_pred == 5.0 and out[365].y_true == 4.0


def test_seasonal_median(spark):
    df = series(spark, days("a", "2019-01-01", 1, 1, 1) + days("a", "2020-01-01", 1, 2, 1) + days("a", "2021-01-01", 1, 9, 1))
    assert ts.aggregate_seasonal(df, method="median").collect()[0].y_true == 2.0
    assert ts.aggregate_seasonal(df).collect()[0].y_true == 4.0


def test_seasonal_skips_days_without_truth_and_msc_keeps_them(spark):
    df = series(spark, days("a", "2019-01-01", 2, lambda t: None if t.day == 2 else 1, 3))
    assert {r.doy for r in ts.aggregate_seasonal(df).collect()} == {1}
    cycle = by(ts.compute_msc(df), "doy")
    assert set(cycle) == {1, 2} and cycle[2].y_pred is None


def test_anomaly_keeps_every_day(spark):
    df = series(spark, days("a", "2019-01-01", 2, 1, 10) + days("a", "2020-01-01", 1, 5, 20))
    out = by(ts.aggregate_anomaly(df), "time")
    assert out[datetime(2019, 1, 1, 12)].y_true == -2.0 and out[datetime(2020, 1, 1, 12)].y_pred == 5.0
    assert out[datetime(2019, 1, 2, 12)].y_true is None and out[datetime(2019, 1, 2, 12)].y_pred == 0.0


def test_short_year_counts_in_the_prediction_mean_only(spark):
    value = {2019: 1, 2020: 3, 2021: 11}
    rows = days("a", "2019-01-01", 200, lambda t: value[t.year], lambda t: value[t.year])
    rows += days("a", "2020-01-01", 200, lambda t: value[t.year], lambda t: value[t.year])
    rows += days("a", "2021-01-01", 100, lambda t: value[t.year], lambda t: value[t.year])
    out = by(ts.aggregate_iav(series(spark, rows)), "time")
    assert out[datetime(2019, 7, 1)].y_true == -1.0 and out[datetime(2019, 7, 1)].y_pred == -4.0
    assert out[datetime(2021, 7, 1)].y_true is None and out[datetime(2021, 7, 1)].y_pred == 6.0


def test_site_mean_is_the_mean_of_yearly_means(spark):
    df = series(spark, days("a", "2019-01-01", 1, 1, 1) + days("a", "2020-01-01", 3, 5, 1))
    assert ts.aggregate_spatial(df).collect()[0].y_true == 3.0


def test_share_threshold(spark):
    rows = hours("a", "2020-01-01", 10, 1, 1) + hours("a", "2020-01-02", 10, 0, 1)
    rows += [("a", "a", datetime(2020, 1, 1, 20), 30, 1)]
    out = by(ts.aggregate_daily(series(spark, rows), F.col("y_true") < 10, minimum=0.5), "time")
    assert out[datetime(2020, 1, 1)].y_true is None  # 10 of 40
    assert out[datetime(2020, 1, 2)].y_true == 0.0  # no share without any size
    with pytest.raises(ValueError):
        ts.aggregate_seasonal(series(spark, rows), minimum=0.5)


def test_null_prediction_removes_scales_of_that_experiment_only(spark):
    rows = hours("a", "2020-01-01", 24, 1, None) + hours("a", "2020-01-02", 24, 1, 2)
    bad = series(spark, rows)
    good = series(spark, hours("a", "2020-01-01", 24, 1, 2), exp=(*EXP[:2], "good", "mean"))
    out = compute_metrics(bad.unionByName(good))
    scales = {m: {r.scale for r in out.where(F.col("model") == m).collect()} for m in ("demo", "good")}
    assert scales["demo"] == {"hourly", "daily"}
    assert len(scales["good"]) == 8
    state = by(ts.scale_state(ts.day_totals(bad.unionByName(good))), "model", "unit")
    assert state["demo", "env"].state == ts.NULL_PREDICTION and state["good", "site_id"].state == ts.OK


def test_rows_without_env_are_left_out_of_env_scales(spark):
    rows = hours("a", "2020-01-01", 24, 1, 2) + [(None, "a", datetime(2020, 1, 1, 5), 100, 100)]
    out = by(compute_metrics(series(spark, rows)), "scale")
    assert out["daily"].mse == 1.0 and out["hourly"].n_samples == 24
    assert out["anom"].env == "a"


def test_multi_year_scales_report_per_site(spark):
    rows = days("s-2019", "2019-01-01", 365, 1, 2, site="s") + days("s-2020", "2020-01-01", 366, 2, 3, site="s")
    out = compute_metrics(series(spark, rows)).collect()
    assert {r.env for r in out if r.scale in ("seasonal", "anom", "iav")} == {"s"}
    assert {r.env for r in out if r.scale == "weekly"} == {"s-2019", "s-2020"}


def test_fused_scales_equal_the_single_operators(spark):
    wave = lambda t: (t.timetuple().tm_yday * 7 + t.year * 3) % 31
    rows = days("s-2019", "2019-01-01", 365, wave, lambda t: wave(t) * 0.7 + t.day, site="s")
    rows += days("s-2020", "2020-01-01", 200, lambda t: None if t.day == 3 else wave(t), lambda t: wave(t) + t.month, site="s")
    rows += hours("q-2020", "2020-03-01", 15, 3, 4, site="q") + hours("q-2020", "2020-03-02", 3, 3, 4, site="q")
    df = series(spark, rows)
    limits = ts.Thresholds(hour_to_day=1)
    fused = {(r.scale, r.env): r for r in compute_metrics(df, thresholds=limits).collect()}
    single = {(r.scale, r.env): r for r in compute_metrics(df, thresholds=limits, registry=dict(DEFAULT_SCALES)).collect()}
    assert fused.keys() == single.keys() and len(fused) > 12
    for key, row in fused.items():
        for a, b in zip(row, single[key]):
            assert a == b or a == pytest.approx(b, rel=1e-9, abs=1e-12), key


def test_unknown_scale_is_skipped(spark):
    with pytest.warns(UserWarning):
        out = compute_metrics(series(spark, hours("a", "2020-01-01", 3, 1, 2)), scales=["hourly", "decadal"])
    assert [r.scale for r in out.collect()] == ["hourly"]
