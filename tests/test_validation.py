import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skillgauge.operators import truth as tr
from skillgauge.operators import validation as va
from skillgauge.schema import PREDICTION_SCHEMA, SETTINGS, TARGETS, TRUTH_SCHEMA
from skillgauge.sources import stores

SITES, HOURS, MODEL, STRATEGY = ["AR-CCg", "AU-Dry"], 24, "demo", "mean"
ROWS = StructType([*PREDICTION_SCHEMA.fields, StructField("path", StringType())])
OFFSET = {"GPP": 10.0, "ET": 3.0, "NEE": -1.0}


def truth_rows():
    start = datetime(2020, 6, 1)
    return [
        (s, t, site, start + timedelta(hours=h), OFFSET[t] + 0.5 * i + math.sin(h / 24 * 2 * math.pi))
        for s in SETTINGS for t in TARGETS for i, site in enumerate(SITES) for h in range(HOURS)
    ]


@pytest.fixture(scope="module")
def truth(spark):
    return spark.createDataFrame(truth_rows(), TRUTH_SCHEMA)


def submission(edit=None, skip=(), combo=("time-split", "GPP")):
    """Prediction rows per file; ``edit`` changes the rows of one file."""
    files = {}
    for s, t, site, time, y in truth_rows():
        if (s, t) not in skip:
            files.setdefault((s, t), []).append([s, t, MODEL, STRATEGY, y, y + 0.25, site, site, time])
    if edit:
        files[combo] = edit(files[combo])
    return files


def listed(s, t, named=MODEL, named_strategy=STRATEGY, folder="in"):
    name = f"{s}_{t}_{named}_val_{named_strategy}_predictions.csv"
    return f"{folder}/{name}", name


def validate(spark, truth, files, model=MODEL, strategy=STRATEGY, named=MODEL, named_strategy=STRATEGY,
             owner=None, recorded=None, config=va.ValidationConfig(), size=1000, more=(), unreadable=()):
    """``more`` are further files of the submission: (path, filename, rows)."""
    held = {listed(s, t, named, named_strategy): rows for (s, t), rows in files.items()}
    held.update({(path, name): rows for path, name, rows in more})
    rows = spark.createDataFrame(
        [(*r, path) for (path, _), f in held.items() for r in f], ROWS)
    names = [(model, strategy, path, name, size) for path, name in held]
    listing = spark.createDataFrame(names, "model_id string, val_strategy string, path string, filename string, bytes long")
    claims = spark.createDataFrame([(model, strategy, owner)], "model_id string, val_strategy string, owner string")
    owners = spark.createDataFrame([(model, recorded)] if recorded else [], "model_id string, recorded_owner string")
    broken = spark.createDataFrame([(p, "bad") for p in unreadable], "path string, problem string")
    return {r.check_name: r for r in va.validate(rows, listing, truth, claims, owners, config, broken).collect()}


def failed(report):
    return {name for name, r in report.items() if not r.passed}


def test_clean_passes(spark, truth):
    report = validate(spark, truth, submission())
    assert set(report) == set(va.CHECKS) and failed(report) == set()
    assert report["ownership"].warnings == ["new model `demo` names no owner"]


def test_missing_file(spark, truth):
    report = validate(spark, truth, submission(skip={("TA40", "NEE")}))
    assert failed(report) == {"files"} and report["files"].errors == ["no file for TA40 x NEE"]


def test_wrong_model_and_strategy(spark, truth):
    assert "files" in failed(validate(spark, truth, submission(), named="other"))
    assert "files" in failed(validate(spark, truth, submission(), named_strategy="max"))


def change(index, value, rows=slice(0, 1)):
    def edit(file):
        for r in file[rows]:
            r[index] = value(r[index]) if callable(value) else value
        return file
    return edit


@pytest.mark.parametrize("edit, check, text", [
    (change(5, float("nan")), "content_caps", "1 predictions are NaN"),
    (change(5, float("inf")), "content_caps", "1 predictions are infinite"),
    (change(5, 1e12), "content_caps", "1 predictions are larger than 1e+06"),
    (lambda f: f + [list(f[0])], "content_caps", "1 rows repeat"),
    (lambda f: f[:-3], "index_completeness", "3 required rows are absent (first: (AU-Dry @ 2020-06-01 21:00:00)"),
    (lambda f: f + [[*f[0][:8], datetime(1999, 1, 1)]], "index_completeness", "1 rows are not in the truth (first: (AR-CCg @ 1999-01-01 00:00:00))"),
    (change(4, lambda y: y + 5, slice(None)), "ytrue_integrity", "in 48 of 48 rows (100.00%, at most by 5)"),
])
def test_each_fault_fails_its_check(spark, truth, edit, check, text):
    report = validate(spark, truth, submission(edit))
    assert check in failed(report)
    assert text in " ".join(report[check].errors)
    assert failed(report) <= {check}


def test_cap_does_not_block_integrity_but_nan_does(spark, truth):
    def both(value):
        def edit(file):
            file[0][5] = value
            file[1][4] += 5
            return file
        return edit
    assert failed(validate(spark, truth, submission(both(1e12)))) == {"content_caps", "ytrue_integrity"}
    assert failed(validate(spark, truth, submission(both(float("nan"))))) == {"content_caps"}


def test_no_overlap_fails_integrity(spark, truth):
    report = validate(spark, truth, submission(change(8, lambda t: t + timedelta(days=400), slice(None))))
    assert failed(report) == {"index_completeness", "ytrue_integrity"}
    assert "shares no row" in report["ytrue_integrity"].errors[0]


def test_small_difference_is_tolerated(spark, truth):
    assert failed(validate(spark, truth, submission(change(4, lambda y: y + 1e-9, slice(None))))) == set()


def test_oversize_file_skips_the_other_checks(spark, truth):
    report = validate(spark, truth, submission(lambda f: f[:-3]), config=va.ValidationConfig(max_file_bytes=10))
    assert failed(report) == {"content_caps"} and len(report["content_caps"].errors) == 9


@pytest.mark.parametrize("value, worst", [(float("nan"), "-"), (None, "-"), (float("inf"), "inf"), (float("-inf"), "inf")])
def test_faulty_truth_values_fail_integrity_only(spark, truth, value, worst):
    report = validate(spark, truth, submission(change(4, value)))
    assert failed(report) == {"ytrue_integrity"}
    assert report["ytrue_integrity"].errors == [f"time-split x GPP: y_true differs from the truth in 1 of 48 rows (2.08%, at most by {worst})"]


def test_file_without_rows_fails(spark, truth):
    report = validate(spark, truth, submission(lambda f: []))
    assert failed(report) == {"index_completeness", "ytrue_integrity"}
    assert report["index_completeness"].errors[0].startswith("time-split x GPP: 48 required rows are absent (first: (AR-CCg @")


def test_second_file_of_a_combo_adds_no_rows(spark, truth):
    files = submission()
    path, name = listed("time-split", "GPP", folder="late")
    report = validate(spark, truth, files, more=[(path, name, files["time-split", "GPP"])])
    assert failed(report) == {"files"} and "has a second file" in report["files"].errors[0]


def test_file_named_for_another_model_adds_no_rows(spark, truth):
    files = submission()
    path, name = listed("time-split", "GPP", named="other")
    spoiled = [[*r[:4], 999.0, *r[5:]] for r in files["time-split", "GPP"]]
    assert failed(validate(spark, truth, files, more=[(path, name, spoiled)])) == {"files"}


def test_unreadable_file_fails_content_and_skips_the_rest(spark, truth):
    path, _ = listed("time-split", "GPP")
    report = validate(spark, truth, submission(lambda f: f[:3]), unreadable=[path])
    assert failed(report) == {"content_caps"}
    assert report["content_caps"].errors == ["time-split x GPP: cannot be read: bad"]


def test_ownership(spark, truth):
    assert failed(validate(spark, truth, submission(), owner="b", recorded="a")) == {"ownership"}
    assert failed(validate(spark, truth, submission(), owner="a", recorded="a")) == set()
    assert failed(validate(spark, truth, submission(), recorded="a")) == {"ownership"}


def test_duplicate_and_unparsed_files(spark):
    name = "TA40_GPP_demo_val_mean_predictions.csv"
    files = spark.createDataFrame(
        [("demo", "mean", "b/" + name, name, 1), ("demo", "mean", "a/" + name, name, 1), ("demo", "mean", "x.csv", "x.csv", 1)],
        "model_id string, val_strategy string, path string, filename string, bytes long")
    verdicts = {r.path: r.verdict for r in va.judge_files(files).collect()}
    assert verdicts == {"a/" + name: "ok", "b/" + name: "duplicate", "x.csv": "unparsed"}


def test_report_json_and_text(spark, truth):
    rows = spark.createDataFrame([("demo", "mean", "files", False, ["bad"], []), ("demo", "mean", "ownership", True, [], ["new"])],
                                 "model_id string, val_strategy string, check_name string, passed boolean, errors array<string>, warnings array<string>")
    whole = va.overall(rows).collect()[0]
    assert whole.passed is False and '"name":"files","passed":false,"errors":["bad"]' in whole.report
    assert {r.text for r in va.report_text(rows).collect()} == {"- [ ] files\n    - bad", "- [x] ownership\n    - warning: new"}


def test_truth_tables(spark, truth, tmp_path):
    path = str(tmp_path / "truth")
    stores.write_truth(truth, path)
    stored = stores.read_truth(spark, path)
    assert stored.count() == 9 * len(SITES) * HOURS
    part = tr.truth_slice(stored, "spatial-easy40", "GPP")
    assert part.count() == len(SITES) * HOURS and part.columns == ["site_id", "time", "y_true"]
    with pytest.raises(ValueError):
        tr.truth_slice(stored, "LST", "GPP")
    stores.write_manifest(stored, str(tmp_path / "manifest"))
    manifest = stores.read_manifest(spark, str(tmp_path / "manifest"))
    assert all(r.matches for r in tr.verify_manifest(stored, manifest).collect())
    grown = stored.unionByName(stored.where("setting = 'TA40' and target = 'ET'").limit(1))
    assert [(r.setting, r.target) for r in tr.verify_manifest(grown, manifest).where("not matches").collect()] == [("TA40", "ET")]
    tr.assert_truth(stored)
    with pytest.raises(ValueError, match="duplicate"):
        tr.assert_truth(grown)
    with pytest.raises(ValueError, match="non-finite"):
        tr.assert_truth(stored.withColumn("y_true", F.when(F.col("setting") == "TA40", float("nan")).otherwise(F.col("y_true"))))


def test_scoring_uses_canonical_truth_and_rejects_uncovered(spark, truth):
    files = submission(change(4, 999.0, slice(None)))
    rows = spark.createDataFrame([tuple(r) for f in files.values() for r in f], PREDICTION_SCHEMA)
    stray = rows.where("setting = 'TA40' and target = 'ET'").limit(1).withColumn("site_id", F.lit("ZZ-NOPE")).withColumn("model", F.lit("stray"))
    out = tr.score_against_truth(rows.unionByName(stray), truth, scales=["hourly"]).collect()
    assert {r.model for r in out} == {"demo"} and len(out) == 9 * len(SITES)
    assert all(r.rmse == pytest.approx(0.25) for r in out)
