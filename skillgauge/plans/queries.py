"""Named queries over the driver tables; every callable takes ``(spark, sf_dir)``.

Results are rounded to six decimals, carry NULL instead of NaN, and use bigint for counts, so
they can be compared with the SQL in ``oracle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.functions import naming
from skillgauge.functions.formatting import significant
from skillgauge.functions.numeric import TIE_BREAK, tidy
from skillgauge.operators import curves, intake, leaderboard as lb, quota, registry, scoring, truth, validation
from skillgauge.operators import temporal as ts
from skillgauge.operators.cleaning import clean_predictions
from skillgauge.operators.regression import compare_metrics
from skillgauge.plans import shapes
from skillgauge.schema import EXPERIMENT, METRICS, with_required_combos
from skillgauge.session import shared_folder
from skillgauge.sources import predictions, stores
from skillgauge.sources.stores import stage
from skillgauge.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

# The derived series have few rows per day at small scale; thresholds are parameters.
LINEITEM_HOURS = 4
EVENT_THRESHOLDS = ts.Thresholds(hour_to_day=1, weekly=2, monthly=2)


def _series(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*EXPERIMENT, *columns, tidy(F.col("y_true")).alias("y_true"), tidy(F.col("y_pred")).alias("y_pred"))


def _metrics(df: DataFrame) -> DataFrame:
    return df.select(
        "target", "setting", "model", "val_strategy", "scale", "env", "n_samples", *[tidy(F.col(m)).alias(m) for m in METRICS])


def lineitem_rows(spark, sf):
    return clean_predictions(shapes.pred_lineitem(spark, sf))


def event_rows(spark, sf):
    return clean_predictions(shapes.pred_events(spark, sf))


def model_metrics(spark, sf) -> DataFrame:
    rows = clean_predictions(shapes.pred_models(spark, sf))
    return scoring.compute_metrics(rows, thresholds=ts.Thresholds(hour_to_day=LINEITEM_HOURS))


def board_metrics(spark, sf) -> DataFrame:
    """Stored metrics of the scales shown on the leaderboard; the others are never computed.

    Leaderboards read metrics many times, so they start from a stored table.
    """
    shown = ["hourly", "weekly", "seasonal", "anom", "iav", "spatial"]
    rows = clean_predictions(shapes.pred_models(spark, sf))
    metrics = scoring.compute_metrics(
        rows, scales=shown, metrics={m: scoring.DEFAULT_METRICS[m] for m in ("rmse", "nse")},
        thresholds=ts.Thresholds(hour_to_day=LINEITEM_HOURS),
    )
    return lb.leaderboard_metrics(stage(metrics, "metrics"))


# --------------------------------------------------------------------- temporal scales


def hourly_masked(spark, sf):
    return _series(ts.hourly(event_rows(spark, sf), F.col("y_true") > 50), "env", "time")


def daily_mean_threshold(spark, sf):
    return _series(ts.aggregate_daily(lineitem_rows(spark, sf), minimum=12, unit="site_id"), "site_id", "time")


def daily_passthrough(spark, sf):
    rows = clean_predictions(shapes.pred_mixed(spark, sf))
    return _series(ts.aggregate_daily(rows, minimum=LINEITEM_HOURS, unit="site_id"), "site_id", "time")


def weekly_mean(spark, sf):
    return _series(ts.aggregate_weekly(event_rows(spark, sf)), "env", "time")


def monthly_mean(spark, sf):
    return _series(ts.aggregate_monthly(lineitem_rows(spark, sf), hour_to_day=LINEITEM_HOURS), "env", "time")


def yearly_mean(spark, sf):
    return _series(ts.aggregate_yearly(lineitem_rows(spark, sf), hour_to_day=12, unit="site_id"), "site_id", "time")


def _cycle(df):
    return _series(df.withColumn("doy", F.col("doy").cast("bigint")), "site_id", "doy")


def seasonal_cycle(spark, sf):
    return _cycle(ts.aggregate_seasonal(lineitem_rows(spark, sf), hour_to_day=12, unit="site_id"))


def seasonal_cycle_median(spark, sf):
    return _cycle(ts.aggregate_seasonal(lineitem_rows(spark, sf), hour_to_day=LINEITEM_HOURS, method="median", unit="site_id"))


def anomaly(spark, sf):
    return _series(ts.aggregate_anomaly(lineitem_rows(spark, sf), hour_to_day=LINEITEM_HOURS, unit="site_id"), "site_id", "time")


def interannual_variability(spark, sf):
    return _series(ts.aggregate_iav(lineitem_rows(spark, sf), hour_to_day=LINEITEM_HOURS, unit="site_id"), "site_id", "time")


def site_mean(spark, sf):
    return _series(ts.aggregate_spatial(lineitem_rows(spark, sf), hour_to_day=LINEITEM_HOURS, unit="site_id"), "site_id")


def weighted_fraction_threshold(spark, sf):
    mask = F.col("y_pred") < 35
    return _series(ts.aggregate_daily(lineitem_rows(spark, sf), mask, minimum=0.6, unit="site_id"), "site_id", "time")


def masked_weekly_fraction(spark, sf):
    mask = F.col("y_pred") < 40
    rows = ts.aggregate_weekly(lineitem_rows(spark, sf), mask, minimum=0.5, hour_to_day=LINEITEM_HOURS, unit="site_id")
    return _series(rows, "site_id", "time")


# --------------------------------------------------------------------- metrics


def metrics_hourly(spark, sf):
    return _metrics(scoring.compute_metrics(event_rows(spark, sf), scales=["hourly"]))


def metrics_all_scales(spark, sf):
    return _metrics(model_metrics(spark, sf))


def sample_size_summary(spark, sf):
    sizes = scoring.sample_sizes(model_metrics(spark, sf))
    return sizes.withColumn("mean_samples", tidy(F.col("mean_samples")))


def custom_metrics(spark, sf):
    """Metrics given by the caller, on a scale given by the caller."""
    metrics = {
        "max_error": lambda yt, yp: F.max(F.abs(yp - yt)),
        "mean_square_log": lambda yt, yp: F.avg(F.pow(F.log1p(yp) - F.log1p(yt), 2)),
    }
    scales = {"yearly": lambda s: ts.yearly_means(s.daily("site_id"), s.keys, s.thresholds.yearly)}
    rows = scoring.compute_metrics(
        lineitem_rows(spark, sf), metrics=metrics, registry=scales, thresholds=ts.Thresholds(hour_to_day=LINEITEM_HOURS, yearly=100)
    )
    return rows.select(*EXPERIMENT, "scale", "env", "n_samples", tidy(F.col("max_error")).alias("max_error"),
                       tidy(F.col("mean_square_log")).alias("mean_square_log"))


def scale_status(spark, sf):
    joined = truth.join_truth(clean_predictions(shapes.sub_events(spark, sf)), shapes.truth_events(spark, sf))
    return ts.scale_state(ts.day_totals(joined), hour_to_day=2).select(*EXPERIMENT, "unit", "daily_input", "state")


# --------------------------------------------------------------------- truth


def truth_manifest(spark, sf):
    return truth.truth_manifest(shapes.truth_events(spark, sf))


def truth_assertions(spark, sf):
    return truth.truth_assertions(shapes.truth_events(spark, sf))


def manifest_verification(spark, sf):
    table = shapes.truth_events(spark, sf)
    recorded = truth.truth_manifest(table).withColumn(
        "rows", F.when(F.col("setting") == "TA40", F.col("rows") + 1).otherwise(F.col("rows")))
    return truth.verify_manifest(table, recorded).select("setting", "target", "rows", "rows_now", "sites", "sites_now", "matches")


def manifest_fingerprint(spark, sf):
    """A recorded manifest against a truth in which values were changed by a billionth: statistics agree, the fingerprint does not."""
    table, path = shapes.truth_events(spark, sf), f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}"
    stores.write_manifest(table, path)
    recorded = stores.read_manifest(spark, path)
    changed = table.withColumn("y_true", F.when(F.col("site_id").cast("bigint") % 97 == 0, F.col("y_true") + 1e-9).otherwise(F.col("y_true")))
    statistics = truth.verify_manifest(changed, recorded.drop("fingerprint")).select("setting", "target", F.col("matches").alias("statistics_match"))
    whole = truth.verify_manifest(changed, recorded).select("setting", "target", "rows", "matches")
    return whole.join(statistics, ["setting", "target"])


def truth_store(spark, sf):
    """The truth written by (setting, target), read back."""
    path = f"{shared_folder(spark)}/truth-{uuid.uuid4().hex}"
    stores.write_truth(shapes.truth_events(spark, sf), path)
    return stores.read_truth(spark, path).groupBy("setting", "target").agg(
        F.count(F.lit(1)).alias("rows"), F.min("site_id").alias("first_site"), F.max("time").alias("last_time"),
        tidy(F.sum("y_true"), 4).alias("total"))


def manifest_store(spark, sf):
    """The manifest of the truth written as JSON, read back and verified."""
    path = f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}"
    table = shapes.truth_events(spark, sf)
    stores.write_manifest(table, path)
    recorded = stores.read_manifest(spark, path)
    verdict = truth.verify_manifest(table, recorded).select("setting", "target", "matches")
    return recorded.drop("fingerprint").join(verdict, ["setting", "target"])


def metric_store(spark, sf):
    """Metrics computed where they are missing from the store, stored by experiment, and read by filter."""
    path = f"{shared_folder(spark)}/metrics-{uuid.uuid4().hex}"
    rows, options = clean_predictions(shapes.pred_models(spark, sf)), {"thresholds": ts.Thresholds(hour_to_day=LINEITEM_HOURS)}
    stores.load_all_metrics(spark, path, rows, models=["xgb"], **options)
    shown = stores.load_all_metrics(spark, path, rows, settings=["TA40", "time-split"], scales=["weekly", "iav", "monthly"], **options)
    return _metrics(shown)


def metric_files(spark, sf):
    """Metrics written as CSV by experiment, read back."""
    path = f"{shared_folder(spark)}/metric-files-{uuid.uuid4().hex}"
    predictions.write_metric_files(scoring.compute_metrics(event_rows(spark, sf), thresholds=EVENT_THRESHOLDS), path)
    return _metrics(predictions.read_metric_files(spark, path))


def truth_coverage(spark, sf):
    return truth.coverage(truth.join_truth(clean_predictions(shapes.sub_events(spark, sf)), shapes.truth_events(spark, sf)))


def truth_join_score(spark, sf):
    metrics = truth.score_against_truth(
        clean_predictions(shapes.scored_events(spark, sf)), shapes.truth_events(spark, sf),
        thresholds=EVENT_THRESHOLDS,
    )
    return _metrics(metrics)


# --------------------------------------------------------------------- validation


def file_names(spark, sf):
    named = shapes.order_files(spark, sf).withColumn("named", naming.parse_file_name(F.col("filename")))
    keys = [F.col(f"named.{k}").alias(k) for k in EXPERIMENT]
    return named.select("path", *keys, F.col("named.is_raw").alias("is_raw")).withColumn(
        "metrics_file", naming.metrics_file_name(*[F.col(k) for k in EXPERIMENT]))


def check_files(spark, sf):
    return validation.check_files(validation.judge_files(shapes.order_files(spark, sf)))


def check_sizes(spark, sf):
    return validation.check_sizes(validation.accepted_files(validation.judge_files(shapes.order_files(spark, sf))))


def _profile(spark, sf):
    ref = shapes.truth_events(spark, sf)
    return validation.file_profile(validation.site_profile(shapes.sub_events(spark, sf), ref), ref)


def check_content(spark, sf):
    return _profile(spark, sf).select(*EXPERIMENT, "n_rows", "n_dup", "n_nan", "n_inf", "n_big", "sound")


def check_index(spark, sf):
    rows, ref = shapes.sub_events(spark, sf), shapes.truth_events(spark, sf)
    sites = stage(validation.site_profile(rows, ref), "site-profile")
    profile = stage(validation.file_profile(sites, ref), "profile")
    return validation.check_index(profile, validation.index_examples(rows, ref, sites, profile))


def check_integrity(spark, sf):
    return _profile(spark, sf).select(
        *EXPERIMENT, "n_match", "n_bad", tidy(F.col("bad_frac")).alias("bad_frac"), tidy(F.col("worst")).alias("worst"))


def check_ownership(spark, sf):
    return validation.check_ownership(shapes.owner_claims(spark, sf), shapes.owner_records(spark, sf))


def _checked(spark, sf) -> DataFrame:
    claims = shapes.sub_events(spark, sf).select(F.col("model").alias("model_id"), "val_strategy").distinct().withColumn(
        "owner", F.when(F.col("model_id") != "short", F.sha2(F.col("model_id").cast("binary"), 256)))
    owners = claims.where(F.col("model_id").isin("clean", "late")).select(
        "model_id", F.when(F.col("model_id") == "clean", F.col("owner")).otherwise("other").alias("recorded_owner"))
    config = validation.ValidationConfig(max_file_bytes=400_000_000)
    return validation.validate(
        shapes.sub_event_rows(spark, sf), shapes.event_files(spark, sf), shapes.truth_events(spark, sf), claims, owners, config,
        shapes.unreadable_event_files(spark, sf))


def validation_report(spark, sf):
    return _checked(spark, sf).select(
        *validation.SUBMISSION, "check_name", "passed", F.array_join("errors", "\n").alias("errors"),
        F.array_join("warnings", "\n").alias("warnings"))


def validation_overall(spark, sf):
    """One verdict per submission, and what its JSON report says."""
    whole = validation.overall(_checked(spark, sf))
    return whole.select(
        *validation.SUBMISSION, "passed", F.size("checks").cast("bigint").alias("n_checks"),
        F.get_json_object("report", "$.passed").cast("boolean").alias("report_passed"))


def validation_text(spark, sf):
    return validation.report_text(_checked(spark, sf))


def regression_compare(spark, sf):
    metrics = stage(model_metrics(spark, sf), "metrics")
    recorded = metrics.withColumn("rmse", F.when(F.col("env").startswith("A"), F.col("rmse") * 1.0001).otherwise(F.col("rmse"))).withColumn(
        "nse", F.when((F.col("scale") != "weekly") | ~F.col("env").endswith("1996"), F.col("nse")))
    return compare_metrics(metrics, recorded).withColumn("worst_relative", tidy(F.col("worst_relative")))


# --------------------------------------------------------------------- leaderboard


def _cells(agg) -> Query:
    def run(spark, sf):
        cells = lb.cells(board_metrics(spark, sf), agg=agg)
        return cells.withColumn("value", tidy(F.col("value")))

    return run


def leaderboard_wide(spark, sf):
    table = lb.wide(lb.cells(board_metrics(spark, sf)))
    return table.select(*lb.ENTRY, *[
        tidy(F.col(f"`{s}_{c}`")).alias(f"{s}_{c}".replace("-", "_").lower()) for s, c in lb.pivot_columns()])


def skill_scores(spark, sf):
    return lb.skill_scores(lb.cells(board_metrics(spark, sf))).select(
        *lb.ENTRY, *lb.COLUMN, *[tidy(F.col(c)).alias(c) for c in ("value", "baseline_value", "skill", "overall")])


def leaderboard_ranked(spark, sf):
    pages = lb.leaderboard_pages(board_metrics(spark, sf), labels=shapes.model_labels(spark, sf))
    return pages.select(
        "aggregate", "target", "place", "model_label", "strategy_label", "model", "val_strategy", "setting", "scale",
        *[tidy(F.col(c), 4).alias(c) for c in ("value", "skill", "overall")])


def leaderboard_texts(spark, sf):
    """Texts, closeness and colour of the cells, with given weights."""
    table = lb.leaderboard(board_metrics(spark, sf), agg="q90", weights={"hourly": 2.0, "iav": 0.5})
    return table.select(
        "target", "place", "model", "val_strategy", "setting", "scale", tidy(F.col("overall"), 4).alias("overall"),
        tidy(F.col("closeness"), 4).alias("closeness"), "value_text", "skill_text", "overall_text", "colour")


def relative_to_best(spark, sf):
    table = lb.relative_to_best(lb.with_facts(lb.cells(board_metrics(spark, sf))))
    return table.select(
        *lb.ENTRY, *lb.COLUMN, tidy(F.col("closeness")).alias("closeness"), "colour",
        significant(F.col("value") + F.lit(TIE_BREAK), 2).alias("text"))


def cdf_curve(spark, sf):
    points = curves.cdf_curve(board_metrics(spark, sf))
    return points.select(*curves.CURVE, "rank", tidy(F.col("value")).alias("value"), tidy(F.col("share")).alias("share"))


def quantile_curve(spark, sf):
    points = curves.quantile_curve(board_metrics(spark, sf), metric="nse")
    return points.select(*curves.CURVE, "rank", tidy(F.col("x")).alias("x"), tidy(F.col("y")).alias("y"))


def metric_by_setting(spark, sf):
    table = curves.metric_by_setting(board_metrics(spark, sf))
    return table.select(
        *curves.CURVE, tidy(F.col("value")).alias("value"),
        F.col("setting_order").cast("bigint").alias("setting_order"), F.col("model_order").cast("bigint").alias("model_order"))


def axis_bound(spark, sf):
    return curves.axis_bound(board_metrics(spark, sf)).withColumn("upper", tidy(F.col("upper")))


def model_order(spark, sf):
    entries = lb.entry_scores(lb.skill_scores(lb.cells(board_metrics(spark, sf))))
    listed = lb.in_model_order(entries, ["constant", "lr", "mlp"])
    return listed.select("target", "model", "val_strategy", F.col("position").cast("bigint").alias("position"),
                         tidy(F.col("overall")).alias("overall"))


# --------------------------------------------------------------------- registry and service jobs


def metadata_schema_check(spark, sf):
    judged = registry.schema_problems(registry.parse_registry(shapes.registry_docs(spark, sf)))
    return judged.select(
        "path", "model_id", "val_strategy", F.size("problems").cast("bigint").alias("n_problems"),
        F.array_join("problems", " | ").alias("problems"))


def intake_gate(spark, sf):
    return registry.intake_gate(shapes.registry_docs(spark, sf), shapes.stored_objects(spark, sf))


def intake_report(spark, sf):
    """Documents at the gate, and the checks of the submissions that it lets through."""
    owners = shapes.sub_events(spark, sf).where(F.col("model").isin("clean", "late")).select(F.col("model").alias("model_id")).distinct().select(
        "model_id", F.when(F.col("model_id") == "clean", F.sha2(F.col("model_id").cast("binary"), 256)).otherwise("other").alias("recorded_owner"))
    found = intake.intake_report(
        shapes.event_registry_docs(spark, sf), shapes.event_objects(spark, sf), shapes.sub_event_rows(spark, sf), shapes.event_files(spark, sf),
        shapes.truth_events(spark, sf), owners, unreadable=shapes.unreadable_event_files(spark, sf))
    return found.select(*validation.SUBMISSION, "stage", "check_name", "passed", F.array_join("errors", "\n").alias("errors"),
                        F.array_join("warnings", "\n").alias("warnings"))


def recorded_owner(spark, sf):
    return registry.recorded_owners(shapes.registry_docs(spark, sf))


def submitter_identity(spark, sf):
    email = F.concat(F.lit("  "), F.replace(F.col("c_name"), F.lit("#"), F.lit("@")), F.lit(".ORG "))
    slug = F.when(F.col("c_custkey") % 2 == 0, F.lower("c_name")).otherwise(F.concat(F.lit("m-"), F.col("c_custkey")))
    return shapes.table(spark, sf, "customer").select(
        "c_custkey", naming.clean_email(email).alias("email"), naming.is_email(email).alias("email_ok"),
        naming.email_owner_hash(email).alias("owner"), slug.alias("slug"), naming.is_model_slug(slug).alias("slug_ok"))


def missing_experiments(spark, sf):
    """Required experiments of every customer's model without a file in the order catalogue."""
    from skillgauge.sources.stores import missing_experiments as missing

    files = shapes.order_files(spark, sf)
    named = files.withColumn("n", naming.parse_file_name(F.col("filename"))).where(F.col("n").isNotNull())
    stored = named.select("n.setting", "n.target", "n.model", "n.val_strategy")
    wanted = with_required_combos(files.select(F.col("model_id").alias("model"), "val_strategy").distinct())
    return missing(wanted.select(*EXPERIMENT), stored)


def quota_admission(spark, sf):
    return quota.admit(shapes.quota_events(spark, sf), per_client_hour=1, per_day=50).select(
        "call_id", "client", "time", "decision")


def _event_registry(spark, sf) -> DataFrame:
    """One document per model with its files; ``copied`` lists one more file than it has."""
    listed = shapes.sub_events(spark, sf).select(*EXPERIMENT).distinct()
    lost = F.struct(F.lit("TA40").alias("setting"), F.lit("lost").alias("target"))
    own = F.array_sort(F.collect_list(F.struct("setting", "target")))  # nine at most
    docs = listed.groupBy("model", "val_strategy").agg(own.alias("own")).withColumn(
        "files", F.when(F.col("model") == "copied", F.concat("own", F.array(lost))).otherwise(F.col("own")))
    doc = F.to_json(F.struct(F.col("model").alias("model_id"), "val_strategy", F.lit("pending").alias("status"), "files"))
    return docs.select(F.concat("model", F.lit(".json")).alias("path"), doc.alias("doc"))


def incremental_pending(spark, sf):
    """Submissions still to be scored when the scored ones cover part of the registry."""
    pending = registry.pending(_event_registry(spark, sf)).withColumnRenamed("model_id", "model")
    status = shapes.sub_events(spark, sf).groupBy("model", "val_strategy").agg(F.count(F.lit(1)).alias("rows")).select(
        "model", "val_strategy", F.when(F.col("model").isin("clean", "shifted"), "scored").otherwise("failed").alias("status"))
    return incremental.unscored(pending, status).select("model", "val_strategy")


def incremental_score(spark, sf):
    """Metrics of the pending submissions that can be scored as a whole."""
    docs = _event_registry(spark, sf)
    metrics, _ = incremental.score_submissions(
        registry.pending(docs).withColumnRenamed("model_id", "model"), clean_predictions(shapes.scored_events(spark, sf)),
        shapes.truth_events(spark, sf), incremental.listed_files(docs),
        thresholds=EVENT_THRESHOLDS)
    return _metrics(metrics)


def incremental_status(spark, sf):
    docs = _event_registry(spark, sf)
    _, status = incremental.score_submissions(
        registry.pending(docs).withColumnRenamed("model_id", "model"), clean_predictions(shapes.scored_events(spark, sf)),
        shapes.truth_events(spark, sf), incremental.listed_files(docs),
        thresholds=EVENT_THRESHOLDS, store_totals=False)  # metrics are not read
    return status


def incremental_stream(spark, sf):
    """The same through a file stream: documents arrive in a folder and are scored on arrival."""
    root = f"{shared_folder(spark)}/incremental-{uuid.uuid4().hex}"
    _event_registry(spark, sf).select(F.col("doc").alias("value")).write.mode("overwrite").option("compression", "none").format("text").save(f"{root}/docs")
    store = incremental.Store(root)
    incremental.run_stream(
        spark, f"{root}/docs", store, clean_predictions(shapes.scored_events(spark, sf)), shapes.truth_events(spark, sf),
        thresholds=EVENT_THRESHOLDS).awaitTermination()
    from skillgauge.sources.stores import read_metrics

    return _metrics(read_metrics(spark, store.metrics))


QUERIES: dict[str, Query] = {
    "leaderboard_cells_median": _cells("median"),
    "leaderboard_cells_q90": _cells("q90"),
    "leaderboard_cells_mean": _cells(F.avg),
    **{f.__name__: f for f in (
        hourly_masked, daily_mean_threshold, daily_passthrough, weekly_mean, monthly_mean, yearly_mean, seasonal_cycle,
        seasonal_cycle_median, anomaly, interannual_variability, site_mean, weighted_fraction_threshold,
        masked_weekly_fraction, metrics_hourly, metrics_all_scales, sample_size_summary, custom_metrics, scale_status,
        truth_manifest, truth_assertions, manifest_verification, manifest_fingerprint, truth_coverage, truth_join_score, file_names,
        check_files, check_sizes, check_content, check_index, check_integrity, check_ownership, validation_report,
        validation_overall, validation_text, truth_store, manifest_store, metric_store, metric_files, leaderboard_texts,
        regression_compare, leaderboard_wide, skill_scores, leaderboard_ranked, relative_to_best, cdf_curve,
        quantile_curve, metric_by_setting, axis_bound, model_order, metadata_schema_check, intake_gate, intake_report, recorded_owner,
        submitter_identity, missing_experiments, quota_admission, incremental_pending, incremental_score,
        incremental_status, incremental_stream,
    )},
}
