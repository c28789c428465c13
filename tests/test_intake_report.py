"""Examples of missing and extra keys by site, and the staged intake."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from skillgauge.operators import intake, registry, validation as v
from skillgauge.schema import SETTINGS, TARGETS, TRUTH_SCHEMA

START = datetime(2020, 6, 1)
ROWS = "setting string, target string, model string, val_strategy string, site_id string, time timestamp_ntz, y_true double, y_pred double"


def examples(spark, truth, rows):
    truth = spark.createDataFrame([("TA40", "ET", s, START + timedelta(hours=h), 1.0) for s, h in truth], TRUTH_SCHEMA)
    rows = spark.createDataFrame([("TA40", "ET", m, "mean", s, START + timedelta(hours=h), 1.0, 1.0) for m, s, h in rows], ROWS)
    sites = v.site_profile(rows, truth)
    profile = v.file_profile(sites, truth)
    return {(r.model, r.side): r.examples for r in v.index_examples(rows, truth, sites, profile).collect()}


def shown(*keys):
    return ", ".join(f"({s} @ {START + timedelta(hours=h):%Y-%m-%d %H:%M:%S})" for s, h in keys)


def test_first_examples_come_from_the_first_sites(spark):
    truth = [(f"s{k}", h) for k in range(9) for h in range(4)]
    whole = [("full", *t) for t in truth]
    late = [("late", *t) for t in truth if t not in [("s7", 0), ("s3", 2), ("s3", 1), ("s8", 0), ("s5", 3), ("s4", 0), ("s6", 1)]]
    few = [("few", "s8", h) for h in range(4)]
    more = [("more", *t) for t in truth] + [("more", s, h) for s, h in [("zz", 1), ("s1", 9), ("aa", 5), ("aa", 5), ("aa", 4), ("b", 0), ("c", 0), ("d", 0)]]
    got = examples(spark, truth, whole + late + few + more)
    assert got == {
        ("late", "missing"): shown(("s3", 1), ("s3", 2), ("s4", 0), ("s5", 3), ("s6", 1)),
        ("few", "missing"): shown(("s0", 0), ("s0", 1), ("s0", 2), ("s0", 3), ("s1", 0)),
        ("more", "extra"): shown(("aa", 4), ("aa", 5), ("b", 0), ("c", 0), ("d", 0)),
    }


def test_truth_of_other_sites_is_left_out(spark):
    truth = spark.createDataFrame([("TA40", "ET", "a", START, 1.0)], TRUTH_SCHEMA)
    rows = spark.createDataFrame([("TA40", "ET", "m", "mean", s, START, 1.0, 1.0) for s in ("a", "b")], ROWS)
    sites = v.site_profile(rows, truth)
    found = v.index_examples(rows, truth, sites, v.file_profile(sites, truth))
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


def document(model, **changes):
    files = [{"filename": f"{s}_{t}_{model}_val_mean_predictions.csv", "setting": s, "target": t, "r2_key": f"in/{model}/{s}{t}"} for s in SETTINGS for t in TARGETS]
    doc = dict.fromkeys(registry.TOP_FIELDS) | {"model_id": model, "val_strategy": "mean", "status": "pending", "is_baseline": False, "owner": model, "files": files} | changes
    return f"{model}.json", json.dumps({k: x for k, x in doc.items() if x != "gone"})


def test_intake_stops_at_the_metadata(spark):
    docs = [document("good"), document("bad"), document("draft", status="draft"), document("bare", email="gone"), document("lost"), ("broken.json", "no json")]
    models = ["good", "bad", "draft", "bare", "lost"]
    files = [(m, "mean", f"in/{m}/{s}{t}", f"{s}_{t}_{m}_val_mean_predictions.csv", 10) for m in models for s in SETTINGS for t in TARGETS]
    files = [f for f in files if not (f[0] == "bad" and "TA40_ET" in f[3])]
    truth = [(s, t, "site", START + timedelta(hours=h), float(h)) for s in SETTINGS for t in TARGETS for h in range(3)]
    objects = [(f"in/{m}/{s}{t}",) for m in models for s in SETTINGS for t in TARGETS if (m, s, t) != ("lost", "TA40", "ET")]
    rows = [(f[2], site, time, y, y + 0.5) for f in files for s, t, site, time, y in truth if f[3].startswith(f"{s}_{t}_")]
    got = intake.intake_report(
        spark.createDataFrame(docs, "path string, doc string"), spark.createDataFrame(objects, "path string"),
        spark.createDataFrame(rows, "path string, site_id string, time timestamp_ntz, y_true double, y_pred double"),
        spark.createDataFrame(files, "model_id string, val_strategy string, path string, filename string, bytes long"),
        spark.createDataFrame(truth, TRUTH_SCHEMA), spark.createDataFrame([("good", "good"), ("bad", "bad")], "model_id string, recorded_owner string"))
    report = {(r.model_id, r.check_name): (r.stage, r.passed, list(r.errors)) for r in got.collect()}
    assert {m for m, c in report if c != "metadata"} == {"good", "bad"} and len(report) == 6 + 2 * 5
    assert all(passed for (m, _), (_, passed, _) in report.items() if m == "good")
    assert report["bad", "files"] == (2, False, ["no file for TA40 x ET"])
    assert report["bare", "metadata"] == (1, False, ["lacks the field email"])
    assert [report[m, "metadata"][1] for m in ("bad", "draft", "lost", "?")] == [True, False, False, False]


def test_rows_are_matched_with_files_once(spark, monkeypatch):
    """Rows meet the few files of admitted submissions in one join, of files whose number is known, and no shuffle by path goes before."""
    seen = []
    monkeypatch.setattr(intake, "validate", lambda rows, files, truth, claims, *more: seen.append(rows) or validate(rows, files, truth, claims, *more))
    validate = v.validate
    test_intake_stops_at_the_metadata(spark)
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_intake_of_nothing(spark):
    empty = lambda schema: spark.createDataFrame([], schema)
    got = intake.intake_report(
        empty("path string, doc string"), empty("path string"), empty("path string, site_id string, time timestamp_ntz, y_true double, y_pred double"),
        empty("model_id string, val_strategy string, path string, filename string, bytes long"), empty(TRUTH_SCHEMA), empty("model_id string, recorded_owner string"))
    assert got.select(F.count(F.lit(1))).first()[0] == 0
