import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skillgauge.functions import naming
from skillgauge.operators import registry as rg
from skillgauge.operators.scoring import compute_metrics
from skillgauge.operators.truth import join_truth
from skillgauge.schema import EXPERIMENT, PREDICTION_SCHEMA
from skillgauge.sources import catalogue, predictions as pr, stores
from skillgauge.sources.registry import read_registry
from skillgauge.streaming import incremental as inc
from skillgauge.streaming.quota import hourly_counts
from tests.helpers import hours, series
from tests.test_validation import submission, truth_rows
from skillgauge.schema import TRUTH_SCHEMA


def document(model="demo", strategy="mean", drop=(), files=None, **fields):
    doc = {"model_id": model, "display_name": model, "email": None, "description": None, "code_url": None, "paper_url": None,
           "owner": "o", "val_strategy": strategy, "submitted_at": "2024", "is_baseline": False, "status": "pending",
           "files": [{"filename": "f.csv", "setting": "TA40", "target": "ET", "r2_key": "k/f.csv"}] if files is None else files}
    doc.update(fields)
    return json.dumps({k: v for k, v in doc.items() if k not in drop})


def table(spark, *docs):
    return spark.createDataFrame([(f"submissions/{i}.json", d) for i, d in enumerate(docs)], "path string, doc string")


def problems(spark, doc):
    return rg.schema_problems(rg.parse_registry(table(spark, doc))).collect()[0].problems


def test_schema(spark):
    assert problems(spark, document()) == []
    assert problems(spark, document(drop=["email"])) == ["lacks the field email"]
    assert problems(spark, document(status="odd")) == ["unknown status 'odd'"]
    assert problems(spark, document(files=[])) == ["lists no files"]
    assert problems(spark, document(drop=["files"])) == ["lists no files"]
    assert problems(spark, document(status="scored")) == ["file 'f.csv' lacks the field sha256"]
    assert problems(spark, document(files=[{"setting": "TA40", "target": "ET", "r2_key": "k"}])) == ["file None lacks the field filename"]
    assert rg.parse_registry(table(spark, "not json")).count() == 0


def test_intake(spark):
    objects = spark.createDataFrame([("k/f.csv",)], "path string")
    scored = document("b", status="scored", files=[{"filename": "f", "setting": "TA40", "target": "ET", "sha256": "0"}])
    lost = document("c", files=[{"filename": n, "setting": "TA40", "target": "ET", "r2_key": n} for n in ("k/z", "k/a")])
    docs = table(spark, document("a"), scored, lost, document("d", drop=["owner"]))
    gate = rg.intake_gate(docs, objects)
    found = {r.model_id: r.message for r in gate.collect()}
    assert found == {"b": "only a `pending` submission can be taken in", "c": "no stored object for `k/z`", "d": "lacks the field owner"}
    assert [r.model_id for r in rg.admitted(docs, gate).collect()] == ["a"]


def test_intake_reports_null_keys_and_unreadable_documents(spark):
    objects = spark.createDataFrame([("k/f.csv",), (None,)], "path string")
    entry = {"filename": "f", "setting": "TA40", "target": "ET", "r2_key": None}
    gate = rg.intake_gate(table(spark, document("a", files=[entry]), "no json", "[1]"), objects)
    assert sorted((r.model_id, r.message) for r in gate.collect()) == [
        ("?", "cannot be read: submissions/1.json"), ("?", "cannot be read: submissions/2.json"), ("a", "no stored object for `None`")]


def test_gate_reads_each_document_once(spark):
    gate = rg.intake_gate(table(spark, document("a"), "no json"), spark.createDataFrame([], "path string"))
    assert "from_json" not in gate._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.model_id for r in gate.collect()) == ["?", "a"]


def test_owner_labels(spark):
    docs = table(spark, document("a", owner="first"), document("a", "max", owner="second"), document("", owner="x"))
    owners = {r.model_id: r.recorded_owner for r in rg.recorded_owners(docs).collect()}
    assert owners["a"] == "first"
    assert {(r.model_id, r.val_strategy) for r in rg.display_labels(docs).collect()} == {("a", "mean"), ("a", "max")}


def test_names(spark):
    names = {
        "spatial-easy40_GPP_lr_val_mean_predictions.csv": ("spatial-easy40", "GPP", "lr", "mean"),
        "TA40_NEE_my_val_mean_net_val_max.csv": ("TA40", "NEE", "my_val_mean_net", "max"),
        "time-split_ET__val_discrepancy.csv": ("time-split", "ET", "", "discrepancy"),
        "garbage.csv": None, "TA40_XX_lr_val_mean.csv": None, "TA40_ET_lr_val_mean.txt": None,
    }
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", naming.parse_file_name(F.col("n")).alias("p"))
    assert {r.n: None if r.p is None else (r.p.setting, r.p.target, r.p.model, r.p.val_strategy) for r in df.collect()} == names
    row = spark.createDataFrame([(" A@B.org ", "  ", "ok-1", "-bad")], "e string, b string, s string, t string").select(
        naming.email_owner_hash(F.col("e")).alias("h"), naming.email_owner_hash(F.col("b")).alias("none"),
        naming.owner_hash(F.lit("a@b.org")).alias("same"), naming.is_model_slug(F.col("s")).alias("ok"),
        naming.is_model_slug(F.col("t")).alias("bad"), naming.is_email(F.col("b")).alias("mail")).collect()[0]
    assert row.h == row.same and row.none is None and row.ok and not row.bad and not row.mail


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_csv_reading(spark, tmp_path):
    folder = tmp_path / "raw"
    write(folder, "TA40_ET_a_val_mean_predictions.csv", ["y_true,y_pred,env,site_id,time", "1.5,2,e,s,2020-01-01 01:00:00", ",NaN,e,s,2020-01-01 02:00:00"])
    write(folder, "TA40_ET_b_val_max_predictions.csv", ["time,extra,site_id,env,y_pred,y_true", "2020-01-01 01:00:00,9,s,e,inf,7", "oops,9,s,e,x,7"])
    write(folder, "TA40_GPP_c_val_max_predictions.csv", ["time,site_id,env,y_pred", "2020-01-01 01:00:00,s,e,1"])
    rows = pr.read_predictions(spark, str(folder), mixed_headers=True).collect()
    a = sorted((r for r in rows if r.model == "a"), key=lambda r: r.time)
    assert (a[0].y_true, a[0].y_pred, a[0].val_strategy, a[0].faulty) == (1.5, 2.0, "mean", False)
    assert a[1].y_true is None and a[1].y_pred is None and not a[1].faulty
    b = [r for r in rows if r.model == "b"]
    assert {(r.y_true, r.y_pred, r.faulty) for r in b} == {(7.0, float("inf"), False), (7.0, None, True)}
    bad = {r.path.split("/")[-1]: r.problem for r in pr.unreadable_files(spark, str(folder), mixed_headers=True).collect()}
    assert bad == {"TA40_ET_b_val_max_predictions.csv": "1 values are no numbers; 1 times cannot be parsed",
                   "TA40_GPP_c_val_max_predictions.csv": "missing columns y_true"}
    with pytest.raises(Exception):
        pr.read_predictions(spark, str(folder)).collect()
    listing = catalogue.list_files(spark, str(folder))
    assert catalogue.find_experiments(listing).count() == 3 and listing.agg(F.min("bytes")).collect()[0][0] > 10
    assert {len(r.sha256) for r in catalogue.hash_files(spark, str(folder)).collect()} == {64}


def test_metric_store(spark, tmp_path):
    path = str(tmp_path / "metrics")
    one = series(spark, hours("a", "2020-01-01", 24, 1, 2))
    two = series(spark, hours("a", "2020-01-01", 24, 1, 4), exp=("TA40", "ET", "x", "mean"))
    both = one.unionByName(two)
    assert stores.missing_experiments(both.select(*EXPERIMENT).distinct(), stores.read_metrics(spark, path)).count() == 2
    stores.write_metrics(compute_metrics(one, scales=["hourly"]), path)
    assert [r.model for r in stores.missing_experiments(both.select(*EXPERIMENT).distinct(), stores.read_metrics(spark, path)).collect()] == ["x"]
    out = stores.load_all_metrics(spark, path, both, scales=["hourly", "daily"])
    assert {(r.model, r.scale) for r in out.collect()} == {("demo", "hourly"), ("x", "hourly")}
    changed = two.withColumn("y_pred", F.lit(11.0))
    assert {r.model: r.mae for r in stores.load_all_metrics(spark, path, changed, rerun=True, scales=["hourly"]).collect()} == {"demo": 1.0, "x": 10.0}
    folder = tmp_path / "csv" / "x_val_max"
    folder.mkdir(parents=True)
    header = "target,setting,model,scale,env,n_samples,mse,rmse,mae,nse,r2_score,bias,relative_mae,relative_bias"
    write(folder, "TA40_ET_x_val_max.csv", [header, "ET,TA40,x,daily,a,3,1,1,1,,0.5,nan,1,1"])
    write(folder, "notes.csv", [header])
    row = pr.read_metric_files(spark, str(tmp_path / "csv")).collect()
    assert len(row) == 1 and row[0].val_strategy == "max" and row[0].n_samples == 3 and row[0].nse is None and row[0].bias is None


def test_metric_files_round_trip_and_bad_files_are_named(spark, tmp_path):
    metrics = compute_metrics(series(spark, hours("a", "2020-01-01", 24, 1, 2)), scales=["hourly", "daily"])
    folder = tmp_path / "out"
    pr.write_metric_files(metrics, str(folder))
    write(tmp_path / "out" / "more", "TA40_ET_x_val_max.csv", ["target,setting", "ET,TA40"])
    back = pr.read_metric_files(spark, str(folder))
    key = lambda r: (r.scale, r.env)
    assert sorted(back.select(*metrics.columns).collect(), key=key) == sorted(metrics.collect(), key=key)
    assert [p.rsplit("/", 1)[1] for p in pr.skipped_metric_files(spark, str(folder))] == ["TA40_ET_x_val_max.csv"]


@pytest.fixture()
def work(spark):
    truth = spark.createDataFrame(truth_rows(), TRUTH_SCHEMA)
    rows = spark.createDataFrame([tuple(r) for f in submission().values() for r in f], PREDICTION_SCHEMA)
    stray = rows.withColumn("model", F.lit("stray")).withColumn(
        "site_id", F.when((F.col("setting") == "TA40") & (F.col("target") == "ET"), "ZZ-NOPE").otherwise(F.col("site_id")))
    return truth, rows.unionByName(stray)


def state(spark, store):
    return {r.model: r.status for r in store.read_status(spark).collect()}


def test_batch_scoring_is_idempotent_and_retries(spark, work, tmp_path):
    truth, rows = work
    store = inc.Store(str(tmp_path / "store"))
    docs = table(spark, document("demo"), document("stray"), document("gone"), document("old", status="scored"))
    inc.score_pending(store, docs, rows, truth)
    assert state(spark, store) == {"demo": "scored", "stray": "failed", "gone": "failed"}
    first = stores.read_metrics(spark, store.metrics).collect()
    assert {r.model for r in first} == {"demo"} and len({(r.setting, r.target) for r in first}) == 9
    fixed = rows.where("model = 'stray'").withColumn("site_id", F.col("env")).unionByName(rows.where("model = 'demo'"))
    inc.score_pending(store, docs, fixed, truth)
    assert state(spark, store) == {"demo": "scored", "stray": "scored", "gone": "failed"}
    again = stores.read_metrics(spark, store.metrics)
    assert again.where("model = 'demo'").count() == len(first) and again.where("model = 'stray'").count() == len(first)


def test_rows_are_not_shuffled_by_submission(spark, work, monkeypatch):
    """The submissions come from a table of unknown, seemingly large size: its few rows are still known as few to the join."""
    truth, rows = work
    docs = table(spark, document("demo"))
    one = spark.range(100_000_000).select((F.col("id") % 2).alias("odd")).distinct().where("odd = 0")
    pending = rg.pending(docs).withColumnRenamed("model_id", "model").crossJoin(one)
    seen, plain = [], inc.metrics_and_coverage
    monkeypatch.setattr(inc, "metrics_and_coverage", lambda joined, **options: seen.append(joined) or plain(joined, **options))
    inc.score_submissions(pending, rows, truth, inc.listed_files(docs))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [model" in plan and "hashpartitioning(model" not in plan


def test_submission_lacking_a_listed_file_is_not_scored(spark, work, tmp_path):
    truth, rows = work
    store = inc.Store(str(tmp_path / "store"))
    both = [{"filename": f"{t}.csv", "setting": "TA40", "target": t, "r2_key": t} for t in ("ET", "GPP")]
    part = rows.where("model = 'demo' and not (setting = 'TA40' and target = 'GPP')")
    inc.score_pending(store, table(spark, document("demo", files=both)), part, truth, scales=["hourly"])
    assert state(spark, store) == {"demo": "failed"} and stores.read_metrics(spark, store.metrics).count() == 0
    inc.score_pending(store, table(spark, document("demo", files=both)), rows, truth, scales=["hourly"])
    assert state(spark, store) == {"demo": "scored"}


def test_repeated_truth_key_raises(spark, work):
    truth, rows = work
    doubled = truth.unionByName(truth.where("setting = 'TA40' and target = 'ET'").limit(1))
    with pytest.raises(Exception, match="truth key repeated"):
        join_truth(rows, doubled).agg(F.sum("y_true")).collect()
    assert join_truth(rows, truth).count() == rows.count()


def test_stream_scores_arrivals_once(spark, work, tmp_path):
    truth, rows = work
    store, inbox = inc.Store(str(tmp_path / "store")), tmp_path / "inbox"
    write(inbox, "1.json", [document("demo")])
    run = lambda: inc.run_stream(spark, str(inbox), store, rows, truth, scales=["hourly"]).awaitTermination()
    run()
    assert state(spark, store) == {"demo": "scored"}
    write(inbox, "2.json", [document("stray")])
    run()
    assert state(spark, store) == {"demo": "scored", "stray": "failed"}
    assert {r.model for r in stores.read_metrics(spark, store.metrics).collect()} == {"demo"}


def test_registry_files_and_quota_stream(spark, tmp_path):
    write(tmp_path / "reg", "a.json", [document("a")])
    assert rg.pending(read_registry(spark, str(tmp_path / "reg"))).collect()[0].model_id == "a"
    calls = spark.createDataFrame([("x", datetime(2024, 1, 1, 0, m)) for m in (1, 2, 3)] + [("x", datetime(2024, 1, 1, 5))], "client string, time timestamp")
    calls.write.parquet(str(tmp_path / "calls"))
    stream = spark.readStream.schema(calls.schema).parquet(str(tmp_path / "calls"))
    query = hourly_counts(stream, 2).writeStream.outputMode("complete").format("memory").queryName("hourly_calls").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.calls, r.over_limit) for r in spark.table("hourly_calls").collect()) == [(1, 0), (3, 1)]
