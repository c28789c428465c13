"""What scoring leaves on disk, and what it does not compute."""

import os
import re
import time

from pyspark.sql import functions as F

from skillgauge.operators import scoring, temporal as ts, truth as tr
from skillgauge.schema import EXPERIMENT
from skillgauge.sources.stores import stage
from tests.helpers import hours, series

LIMITS = ts.Thresholds(hour_to_day=2, weekly=2, monthly=2, seasonal=1, anom=1, iav=2, spatial=2)


def two_models(spark):
    rows = [r for n, site in enumerate(("s1", "s2", "s3")) for r in hours(site, "2020-01-01", 24 * 9, 1.0 + n, 2.0)]
    other = series(spark, rows[:300], exp=("time-split", "GPP", "other", "mean"))
    return series(spark, rows).withColumn("y_true", F.col("y_true") + F.hour("time")).unionByName(other)


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(k).getName() for k in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_a_stage_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    staged = stage(spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count(), "left")
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert staged.count() == 10
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_pipeline_leaves_only_the_rows_of_its_stages(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    docs = tmp_path / "documents.parquet"
    spark.range(50).withColumn("doc_id", F.col("id") % 7).write.parquet(str(docs))
    counted = lambda _, df, sf: stage(stage(df, "kept").groupBy("doc_id").count().select("doc_id"), "counted")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", counted), ("two", counted)])
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 7
    new = set(os.listdir(shared)) - before
    assert len(new) == 1 and sorted(os.listdir(f"{shared}/{new.pop()}")) == ["0-one", "1-two"]


def test_metrics_of_units_need_no_shuffle_of_their_own(spark):
    found, _ = scoring.metrics_and_coverage(two_models(spark), thresholds=LIMITS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\([^)]*slot#", plan)
    assert not re.search(r"hashpartitioning\([^)]*scale#", plan)  # no shuffle by (experiment, scale, unit)


def test_metrics_of_chosen_experiments_only(spark):
    rows = two_models(spark)
    chosen = lambda found: found.where("model = 'other'").select(*EXPERIMENT)
    for by_day in (False, True):
        some, found = scoring.metrics_and_coverage(rows, thresholds=LIMITS, chosen=chosen, by_day=by_day)
        every, _ = scoring.metrics_and_coverage(rows, thresholds=LIMITS, by_day=by_day)
        want = {tuple(r) for r in every.where("model = 'other'").collect()}
        assert want and {tuple(r) for r in some.collect()} == want
        assert {r.model for r in found.collect()} == {"demo", "other"}


def test_uncovered_experiments_are_not_scored(spark):
    rows = two_models(spark)
    truth = rows.where("model = 'demo'").select(*tr.TRUTH_KEYS, "y_true").where("site_id <> 's3'")
    got = tr.score_against_truth(rows, truth, thresholds=LIMITS)
    assert {r.model for r in got.collect()} == {"other"}  # its rows are all of s1 and s2
