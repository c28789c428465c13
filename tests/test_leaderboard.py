import random

import pytest
from pyspark.sql import functions as F

from skillgauge.functions.formatting import cell_text, closeness, colour, significant
from skillgauge.operators import curves
from skillgauge.operators import leaderboard as lb
from skillgauge.operators.regression import compare_metrics

SCHEMA = "target string, model string, val_strategy string, setting string, scale string, env string, rmse double"
SETTINGS = ["time-split", "spatial-easy40", "TA40"]


def toy(spark, models=(("lr", "mean", 1.0), ("foo", "mean", 0.5)), scales=("hourly", "weekly")):
    return spark.createDataFrame(
        [("ET", m, v, s, c, "x", None if e is None else float(e)) for m, v, e in models for s in SETTINGS for c in scales], SCHEMA)


def test_half_the_error_is_half_the_skill(spark):
    rows = lb.leaderboard(toy(spark)).collect()
    foo = [r for r in rows if r.model == "foo"]
    assert len(foo) == 6 and all(r.skill == 0.5 and r.overall == 0.5 and r.place == 1 for r in foo)
    assert foo[0].value_text == "0.5000" and foo[0].colour == "63BE7B"
    assert all(r.skill == 0.0 and r.place == 2 and r.colour == "FFFFFF" for r in rows if r.model == "lr")


def test_labels_come_after_scoring(spark):
    labels = spark.createDataFrame(
        [("foo", "mean", "Foo Net", "CV-mean"), ("lr", None, "Linear", " ")],
        "model_id string, val_strategy string, display_name string, val_strategy_display string")
    rows = lb.leaderboard(toy(spark), labels=labels).collect()
    assert {(r.model, r.model_label, r.strategy_label) for r in rows} == {("foo", "Foo Net", "CV-mean"), ("lr", "Linear", "mean")}
    assert {(r.model_label, r.strategy_label) for r in lb.leaderboard(toy(spark)).collect()} == {("foo", "mean"), ("lr", "mean")}


def test_baseline_is_the_first_strategy(spark):
    df = toy(spark, (("lr", "mean", 1.0), ("lr", "max", 2.0), ("foo", "mean", 1.0)))
    skill = {(r.model, r.val_strategy): r.skill for r in lb.skill_scores(lb.cells(df)).collect()}
    assert skill == {("lr", "max"): 0.0, ("lr", "mean"): 0.5, ("foo", "mean"): 0.5}


def test_column_the_baseline_lacks_has_no_skill(spark):
    df = toy(spark).where("not (model = 'lr' and scale = 'weekly')")
    rows = [r for r in lb.skill_scores(lb.cells(df)).collect() if r.model == "foo"]
    assert {(r.scale, r.skill) for r in rows} == {("hourly", 0.5), ("weekly", None)} and all(r.overall == 0.5 for r in rows)


def test_without_baseline_there_is_no_score(spark):
    rows = lb.leaderboard(toy(spark, (("foo", "mean", 0.5),))).collect()
    assert len(rows) == 6 and all(r.skill is None and r.place is None and r.skill_text == "-" for r in rows)


def test_dead_model_vanishes(spark):
    df = toy(spark, (("lr", "mean", 1.0), ("dead", "mean", None)))
    assert {r.model for r in lb.wide(lb.cells(df)).collect()} == {"lr"}


def test_zero_baseline(spark):
    df = toy(spark, (("lr", "mean", 0.0), ("foo", "mean", 1.0)))
    skill = {r.model: r.skill for r in lb.skill_scores(lb.cells(df)).collect()}
    assert skill == {"lr": None, "foo": float("-inf")}


def test_weights_and_aggregates(spark):
    df = spark.createDataFrame(
        [("ET", "lr", "mean", "TA40", s, "x", 1.0) for s in ("hourly", "weekly")]
        + [("ET", "m", "mean", "TA40", "hourly", "x", 0.5), ("ET", "m", "mean", "TA40", "weekly", "x", 1.0)], SCHEMA)
    out = {r.model: r.overall for r in lb.skill_scores(lb.cells(df), weights={"hourly": 3.0}).collect()}
    assert out["m"] == pytest.approx(0.375)
    many = spark.createDataFrame([("ET", "lr", "mean", "TA40", "hourly", str(i), float(i)) for i in range(11)], SCHEMA)
    for agg, expected in (("median", 5.0), ("q90", 9.0), ("0.25", 2.5), ("mean", 5.0), (F.max, 10.0)):
        assert lb.cells(many, agg=agg).collect()[0].value == pytest.approx(expected)


def test_wide_columns_and_shown_rows(spark):
    df = toy(spark, scales=("hourly", "daily", "spatial")).unionByName(toy(spark).withColumn("setting", F.lit("LST")))
    shown = lb.leaderboard_metrics(df)
    assert {(r.setting, r.scale) for r in shown.collect()} == {(s, c) for s in SETTINGS for c in ("hourly", "site-mean")}
    table = lb.wide(lb.cells(shown))
    assert table.columns[3:6] == ["time-split_hourly", "time-split_daily", "time-split_weekly"]
    assert table.columns[10] == "time-split_site-mean"


def test_model_order(spark):
    entries = lb.entry_scores(lb.skill_scores(lb.cells(toy(spark))))
    rows = sorted(lb.in_model_order(entries, ["absent", "foo"]).collect(), key=lambda r: r.position)
    assert [(r.model, r.overall) for r in rows] == [("absent", None), ("foo", 0.5)]


def test_formats(spark):
    numbers = [0.0, 5.0, 0.00012345, 123.456, 99.6, 0.0999, 1e6, 1.5e-5, 2.5e100, 12.0]
    df = spark.createDataFrame([(v,) for v in numbers], "v double")
    for digits in (2, 3):
        texts = [r[0] for r in df.select(significant(F.col("v"), digits)).collect()]
        assert texts == ["0" if v == 0 else f"{v:.{digits}g}" for v in numbers]
    cells = df.select(cell_text(F.col("v"), F.lit("ET")), cell_text(F.lit(None).cast("double"), F.lit("GPP"))).collect()
    assert cells[3][0] == "123.4560" and cells[3][1] == "-"


def test_colours(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 1.1, 1.2, 3.0, None)], "v double")
    share = closeness(F.col("v"), F.lit(1.0))
    out = df.select(share.alias("s"), colour(share).alias("c")).collect()
    assert [r.s for r in out] == pytest.approx([1.0, 0.5, 0.0, 0.0, None])
    assert [r.c for r in out] == ["63BE7B", "B1DEBD", "FFFFFF", "FFFFFF", "FFFFFF"]
    high = df.select(closeness(F.col("v"), F.lit(1.0), lower_is_better=False)).collect()
    assert high[0][0] == 1.0 and high[4][0] is None


def test_curves(spark):
    rng = random.Random(2)
    values = [round(rng.random(), 1) for _ in range(60)]
    df = spark.createDataFrame([("ET", "lr", "mean", "TA40", "hourly", str(i), v) for i, v in enumerate(values)], SCHEMA)
    points = sorted(curves.cdf_curve(df).collect(), key=lambda r: r["rank"])
    assert [r.value for r in points] == sorted(values)
    assert [r.share for r in points] == pytest.approx([i / 59 for i in range(60)])
    up = sorted(curves.quantile_curve(df.withColumnRenamed("rmse", "nse"), "nse").collect(), key=lambda r: r["rank"])
    assert [r.y for r in up] == sorted(values, reverse=True)
    assert curves.cdf_curve(df.limit(1)).collect()[0].share == 0.0
    assert curves.metric_by_setting(df, agg="max").collect()[0].value == max(values)
    assert curves.metric_by_setting(df).collect()[0].setting_order == 3


def test_regression_compare(spark):
    schema = "setting string, target string, model string, val_strategy string, scale string, env string, mse double, bias double"
    key = ("TA40", "ET", "lr", "mean", "daily")
    new = spark.createDataFrame([(*key, "a", 1.0, 1e-15), (*key, "b", 2.0, None), (*key, "c", 4.0, 1.0)], schema)
    ref = spark.createDataFrame([(*key, "a", 1.0 + 1e-8, 0.0), (*key, "b", 2.1, 1.0), (*key, "c", 4.0, 1.0)], schema)
    out = {r.metric: r for r in compare_metrics(new, ref, metrics=["mse", "bias"]).collect()}
    assert out["mse"].mismatches == 1 and out["mse"].worst_relative == pytest.approx(0.1 / 2.1)
    assert out["bias"].mismatches == 1 and out["bias"].worst_relative == 0.0 and out["bias"].cells == 3
