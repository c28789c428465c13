"""Submission checks: files, content, index completeness, truth integrity, ownership.

All submissions are checked in one plan. Messages are rows
``(model_id, val_strategy, check_name, severity, message)``; ``report`` folds them to one row per
check. A check that found nothing still has its row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skillgauge.functions.formatting import significant
from skillgauge.functions.naming import parse_file_name
from skillgauge.functions.numeric import is_close, is_infinite, ratio
from skillgauge.operators.ranking import first_rows
from skillgauge.operators.truth import TRUTH_KEYS, canonical_truth
from skillgauge.schema import EXPERIMENT, SETTINGS, TARGETS
from skillgauge.sources.stores import stage

SUBMISSION = ["model_id", "val_strategy"]
CHECKS = ["files", "content_caps", "index_completeness", "ytrue_integrity", "ownership"]
EXAMPLES = 5


@dataclass(frozen=True)
class ValidationConfig:
    max_file_bytes: int = 400_000_000
    max_abs_ypred: float = 1e6
    ytrue_rtol: float = 1e-5
    ytrue_atol: float = 1e-6
    ytrue_max_mismatch_frac: float = 0.0


def _tag(setting: Column, target: Column) -> Column:
    return F.concat(setting, F.lit(" x "), target)


def _quoted(col: Column) -> Column:
    return F.concat(F.lit("`"), col, F.lit("`"))


def told(failed: Column, *parts: Column | str) -> Column:
    """The text of a failed test. A missing part shows as ``-``, so that a failure never goes untold."""
    texts = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("-")) for p in parts]
    return F.when(F.coalesce(failed, F.lit(False)), F.concat(*texts))


def messages(df: DataFrame, check: str, severity: str = "error", **texts: Column) -> DataFrame:
    """One row per non-NULL text.

    The outer form keeps the texts out of inferred filters, where each would be built again.
    """
    return (
        df.select(*SUBMISSION, F.explode_outer(F.array(*texts.values())).alias("message"))
        .where(F.col("message").isNotNull())
        .select(*SUBMISSION, F.lit(check).alias("check_name"), F.lit(severity).alias("severity"), "message")
    )


# --------------------------------------------------------------------- files


def name_files(files: DataFrame) -> DataFrame:
    """Each file with its parsed name and ``verdict``: ok, unparsed, wrong_model or wrong_strategy.

    ``files`` is (model_id, val_strategy, path, filename, ...).
    """
    return files.withColumn("named", parse_file_name(F.col("filename"))).select(
        *files.columns, F.col("named.setting").alias("setting"), F.col("named.target").alias("target"),
        F.col("named.model").alias("named_model"), F.col("named.val_strategy").alias("named_strategy"),
    ).withColumn(
        "verdict",
        F.when(F.col("setting").isNull(), "unparsed")
        .when(F.col("named_model") != F.col("model_id"), "wrong_model")
        .when(F.col("named_strategy") != F.col("val_strategy"), "wrong_strategy")
        .otherwise("ok"),
    )


def judge_files(files: DataFrame) -> DataFrame:
    """``name_files`` plus the verdict ``duplicate``: of the files of one (setting, target) the
    first path counts. A missing path or name parses to nothing.

    Names are parsed before the files are shuffled by submission, so that no later use parses them
    again; the window and all checks by submission find their rows in place.
    """
    named = name_files(files).repartition(*SUBMISSION)
    combo = Window.partitionBy(*SUBMISSION, "setting", "target")
    first = F.min(F.when(F.col("verdict") == "ok", F.struct("path", "filename"))).over(combo)
    return named.withColumn("first", first).withColumn(
        "verdict",
        F.when((F.col("verdict") == "ok") & (F.col("path") != F.col("first.path")), "duplicate").otherwise(F.col("verdict")),
    ).withColumn("first_filename", F.col("first.filename")).drop("first")


def accepted_files(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("verdict") == "ok")


def missing_combos(judged: DataFrame) -> DataFrame:
    """Submissions that lack a required (setting, target), with the missing ones as sorted text."""
    every = F.array(*[F.lit(f"{s} x {t}") for s in sorted(SETTINGS) for t in sorted(TARGETS)])
    have = F.collect_set(F.when(F.col("verdict").isin("ok", "duplicate"), _tag(F.col("setting"), F.col("target"))))  # at most 9
    return (
        judged.groupBy(*SUBMISSION).agg(have.alias("have"))
        .withColumn("missing", F.array_sort(F.array_except(every, F.col("have"))))
        .where(F.size("missing") > 0)
        .select(*SUBMISSION, F.size("missing").alias("n_missing"), F.array_join("missing", ", ").alias("missing"))
    )


def check_files(judged: DataFrame) -> DataFrame:
    name, verdict = _quoted(F.col("filename")), F.col("verdict")
    combo = _tag(F.col("setting"), F.col("target"))
    per_file = messages(
        judged, "files",
        text=F.coalesce(
            told(verdict == "unparsed", name, ": not named {setting}_{target}_{model}_val_{strategy}_predictions.csv"),
            told(verdict == "wrong_model", name, ": names the model ", _quoted(F.col("named_model")), ", claimed is ", _quoted(F.col("model_id"))),
            told(verdict == "wrong_strategy", name, ": names the strategy ", _quoted(F.col("named_strategy")), ", claimed is ", _quoted(F.col("val_strategy"))),
            told(verdict == "duplicate", combo, " has a second file ", name, " beside ", _quoted(F.col("first_filename"))),
        ),
    )
    absent = messages(missing_combos(judged), "files", text=F.concat(F.lit("no file for "), F.col("missing")))
    return per_file.unionByName(absent)


# --------------------------------------------------------------------- content, index, integrity


def key_profile(rows: DataFrame, config: ValidationConfig = ValidationConfig()) -> DataFrame:
    """One row per submitted key with its copies and faulty predictions.

    Copies are combined before the shuffle, so a key repeated any number of times stays one row.
    """
    y_pred = F.col("y_pred")
    missing = y_pred.isNull() | F.isnan(y_pred)
    return rows.groupBy(*EXPERIMENT, "site_id", "time").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(missing).alias("n_nan"),
        F.count_if(is_infinite(y_pred)).alias("n_inf"),
        F.count_if(~missing & (F.abs(y_pred) > F.lit(config.max_abs_ypred))).alias("n_big"),
        F.max(F.when(~F.isnan("y_true"), F.col("y_true"))).alias("y_sub"),
    )


COUNTERS = ["n_rows", "n_dup", "n_nan", "n_inf", "n_big", "n_match", "n_extra", "n_bad"]


def site_profile(rows: DataFrame, truth: DataFrame, config: ValidationConfig = ValidationConfig()) -> DataFrame:
    """The counters of every site of a file, which add up to those of the file."""
    canonical = canonical_truth(truth).select(*TRUTH_KEYS, F.col("y_true").alias("y_ref"), F.lit(True).alias("known"))
    keyed = key_profile(rows, config).join(canonical, TRUTH_KEYS, "left")
    known = F.coalesce(F.col("known"), F.lit(False))
    bad = known & ~is_close(F.col("y_sub"), F.col("y_ref"), config.ytrue_rtol, config.ytrue_atol)
    return keyed.groupBy(*EXPERIMENT, "site_id").agg(
        F.sum("copies").alias("n_rows"),
        F.sum(F.col("copies") - 1).alias("n_dup"),
        F.sum("n_nan").alias("n_nan"),
        F.sum("n_inf").alias("n_inf"),
        F.sum("n_big").alias("n_big"),
        F.count_if(known).alias("n_match"),
        F.count_if(~known).alias("n_extra"),
        F.count_if(bad).alias("n_bad"),
        F.max(F.when(bad, F.abs(F.col("y_sub") - F.col("y_ref")))).alias("worst"),
    )


def file_profile(sites: DataFrame, truth: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """All counters of one file in one row, from those of its sites: content, index and integrity. With ``files``
    (experiment keys) every listed file has its row, also one without any rows.

    Missing keys are counted as truth rows minus matched keys, so the truth is shuffled once and
    not once per submission.
    """
    per_file = sites.groupBy(*EXPERIMENT).agg(*[F.sum(c).alias(c) for c in COUNTERS], F.max("worst").alias("worst"))
    if files is not None:
        per_file = files.select(*EXPERIMENT).join(per_file, EXPERIMENT, "left").na.fill(0, COUNTERS)
    required = truth.groupBy("setting", "target").agg(F.count(F.lit(1)).alias("n_required"))
    sound = (F.col("n_dup") == 0) & (F.col("n_nan") == 0) & (F.col("n_inf") == 0)
    return (
        per_file.join(required, ["setting", "target"], "left")
        .withColumn("n_required", F.coalesce("n_required", F.lit(0)))
        .withColumn("n_missing", F.col("n_required") - F.col("n_match"))
        .withColumn("sound", sound)
        .withColumn("bad_frac", F.when(sound, ratio(F.col("n_bad").cast("double"), F.col("n_match").cast("double"))))
    )


def index_examples(rows: DataFrame, truth: DataFrame, sites: DataFrame, profile: DataFrame, n: int = EXAMPLES) -> DataFrame:
    """The first ``n`` missing and extra keys of every file that has any.

    Counts by site tell where they are: keys come in order of site, so those of the first ``n`` sites with a
    gap (or a surplus) hold them. Only the rows of these sites are compared key by key, at most ``n`` sites a file
    whatever the truth holds; of the others one count a site is looked at.
    """
    keys, place = ["site_id", "time"], [*EXPERIMENT, "site_id"]
    known = truth.groupBy("setting", "target", "site_id").agg(F.count(F.lit(1)).alias("n_known"))
    incomplete = profile.where(F.col("n_missing") > 0).select(*EXPERIMENT)
    counted = known.join(incomplete, ["setting", "target"]).join(sites.select(*place, "n_match"), place, "left")
    gaps = counted.where(F.col("n_known") > F.coalesce("n_match", F.lit(0))).select(*place, F.lit("missing").alias("side"))
    more = sites.where(F.col("n_extra") > 0).select(*place, F.lit("extra").alias("side"))
    named = first_rows(gaps.unionByName(more).where(F.col("site_id").isNotNull()), [*EXPERIMENT, "side"], [F.col("site_id")], n, "site_id")
    nameless = more.where(F.col("site_id").isNull())  # its rows come before all others
    wanted = stage(named.select(*place, "side").unionByName(nameless), "example-sites")
    at = wanted.select("setting", "target", F.col("model").alias("m"), F.col("val_strategy").alias("v"), F.col("site_id").alias("s"), "side")
    submitted = rows.select(*place, "time")
    near = submitted.join(at, (submitted["setting"] == at["setting"]) & (submitted["target"] == at["target"]) & (submitted["model"] == at["m"])
                          & (submitted["val_strategy"] == at["v"]) & submitted["site_id"].eqNullSafe(at["s"]))
    near = near.select(*[submitted[c] for c in (*place, "time")], "side")
    there = truth.select(*TRUTH_KEYS).join(wanted.where("side = 'extra'"), ["setting", "target", "site_id"], "left_semi")
    extra = near.where("side = 'extra'").select(*place, "time").join(there, TRUTH_KEYS, "left_anti").distinct()
    required = truth.select(*TRUTH_KEYS).join(wanted.where("side = 'missing'").drop("side"), ["setting", "target", "site_id"])
    missing = required.join(near.where("side = 'missing'").select(*place, "time"), [*EXPERIMENT, *keys], "left_anti").select(*place, "time")
    sides = extra.withColumn("side", F.lit("extra")).unionByName(missing.withColumn("side", F.lit("missing")))
    picked = first_rows(sides, [*EXPERIMENT, "side"], [F.col("site_id"), F.col("time")], n, "time")
    shown = F.concat(F.lit("("), F.col("site_id"), F.lit(" @ "), F.date_format("time", "yyyy-MM-dd HH:mm:ss"), F.lit(")"))
    return picked.groupBy(*EXPERIMENT, "side").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("place", shown.alias("shown")))).getField("shown"), ", ").alias("examples")
    )


def _as_submission(df: DataFrame) -> DataFrame:
    return df.withColumn("model_id", F.col("model"))


def check_content(profile: DataFrame, config: ValidationConfig = ValidationConfig()) -> DataFrame:
    tag = _tag(F.col("setting"), F.col("target"))
    text = lambda n, tail: told(F.col(n) > 0, tag, ": ", F.col(n), tail)
    return messages(
        _as_submission(profile), "content_caps",
        dup=text("n_dup", " rows repeat a (site_id, time)"),
        nan=text("n_nan", " predictions are NaN"),
        inf=text("n_inf", " predictions are infinite"),
        big=text("n_big", f" predictions are larger than {config.max_abs_ypred:g}"),
    )


def check_sizes(accepted: DataFrame, config: ValidationConfig = ValidationConfig()) -> DataFrame:
    """Oversize files; their rows are left out of the content checks (``opened_files``)."""
    return messages(
        accepted, "content_caps",
        size=told(F.col("bytes") > config.max_file_bytes, _tag(F.col("setting"), F.col("target")), ": has ", F.col("bytes"),
                  f" bytes, more than {config.max_file_bytes}"),
    )


def check_readable(accepted: DataFrame, unreadable: DataFrame) -> DataFrame:
    """Accepted files that cannot be read (``unreadable``: path, problem)."""
    broken = accepted.join(unreadable.groupBy("path").agg(F.min("problem").alias("problem")), "path")
    return messages(broken, "content_caps", text=F.concat(
        _tag(F.col("setting"), F.col("target")), F.lit(": cannot be read: "), F.coalesce("problem", F.lit("-"))))


def opened_files(accepted: DataFrame, config: ValidationConfig = ValidationConfig(), unreadable: DataFrame | None = None) -> DataFrame:
    """(path, experiment keys) of the accepted files whose rows are looked at: within the size cap
    and readable. The keys are the submission's own."""
    fit = accepted.where(~F.coalesce(F.col("bytes") > config.max_file_bytes, F.lit(False)))
    if unreadable is not None:
        fit = fit.join(unreadable.select("path"), "path", "left_anti")
    return fit.select("path", "setting", "target", F.col("model_id").alias("model"), "val_strategy")


def rows_of_files(rows: DataFrame, opened: DataFrame) -> DataFrame:
    """Rows of the opened files under the keys of their submission. Rows belong to a file by ``path``,
    so a second file of a combo or a file named for another model adds nothing."""
    return rows.select("path", "site_id", "time", "y_true", "y_pred").join(opened, "path")


def check_index(profile: DataFrame, examples: DataFrame) -> DataFrame:
    sides = examples.groupBy(*EXPERIMENT).agg(
        F.max(F.when(F.col("side") == "missing", F.col("examples"))).alias("missing_eg"),
        F.max(F.when(F.col("side") == "extra", F.col("examples"))).alias("extra_eg"),
    )
    tag = _tag(F.col("setting"), F.col("target"))
    return messages(
        _as_submission(profile.join(sides, EXPERIMENT, "left")), "index_completeness",
        none=told(F.col("n_required") == 0, tag, ": the truth has no rows"),
        missing=told(F.col("n_missing") > 0, tag, ": ", F.col("n_missing"), " required rows are absent (first: ", F.col("missing_eg"), ")"),
        extra=told(F.col("n_extra") > 0, tag, ": ", F.col("n_extra"), " rows are not in the truth (first: ", F.col("extra_eg"), ")"),
    )


def check_integrity(profile: DataFrame, config: ValidationConfig = ValidationConfig()) -> DataFrame:
    """Runs on structurally sound files only."""
    tag, sound = _tag(F.col("setting"), F.col("target")), F.col("sound")
    return messages(
        _as_submission(profile), "ytrue_integrity",
        none=told(sound & (F.col("n_match") == 0), tag, ": shares no row with the truth"),
        bad=told(sound & (F.col("bad_frac") > config.ytrue_max_mismatch_frac), tag, ": y_true differs from the truth in ", F.col("n_bad"), " of ",
                 F.col("n_match"), " rows (", F.format_string("%.2f%%", F.col("bad_frac") * 100), ", at most by ", significant(F.col("worst"), 3), ")"),
    )


def check_ownership(claims: DataFrame, owners: DataFrame) -> DataFrame:
    """``claims`` (model_id, val_strategy, owner) against ``owners`` (model_id, recorded_owner)."""
    joined = claims.join(owners.select("model_id", "recorded_owner"), "model_id", "left")
    owner, recorded = F.nullif(F.col("owner"), F.lit("")), F.col("recorded_owner")
    clash = recorded.isNotNull() & ~F.coalesce(F.col("owner") == recorded, F.lit(False))
    errors = messages(joined, "ownership", text=told(clash, "model ", _quoted(F.col("model_id")), " is recorded for another owner"))
    warnings = messages(joined, "ownership", "warning", text=told(
        recorded.isNull() & owner.isNull(), "new model ", _quoted(F.col("model_id")), " names no owner"))
    return errors.unionByName(warnings)


# --------------------------------------------------------------------- report


def report(submissions: DataFrame, found: DataFrame, checks: list[str] = CHECKS) -> DataFrame:
    """One row per (submission, check): passed, errors, warnings. Every check has its row.

    A submission has a bounded file set, so its messages form short lists.
    """
    listed = found.groupBy(*SUBMISSION, "check_name").agg(
        F.array_sort(F.collect_list(F.when(F.col("severity") == "error", F.col("message")))).alias("errors"),
        F.array_sort(F.collect_list(F.when(F.col("severity") == "warning", F.col("message")))).alias("warnings"),
    )
    every = submissions.select(*SUBMISSION).distinct().withColumn(
        "check_name", F.explode(F.array(*[F.lit(c) for c in checks]))
    )
    empty = F.array().cast("array<string>")
    return every.join(listed, [*SUBMISSION, "check_name"], "left").select(
        *SUBMISSION, "check_name",
        (F.size(F.coalesce("errors", empty)) == 0).alias("passed"),
        F.coalesce("errors", empty).alias("errors"),
        F.coalesce("warnings", empty).alias("warnings"),
    )


def overall(checks: DataFrame) -> DataFrame:
    """One row per submission: passed when every check passed, and the report as JSON."""
    one = F.struct(F.col("check_name").alias("name"), "passed", "errors", "warnings")
    return checks.groupBy(*SUBMISSION).agg(
        F.bool_and("passed").alias("passed"),
        F.array_sort(F.collect_list(one)).alias("checks"),
    ).withColumn("report", F.to_json(F.struct("passed", *SUBMISSION, "checks")))


def report_text(checks: DataFrame) -> DataFrame:
    """One text line per check: a mark, the name, then errors and warnings."""
    lines = F.concat(
        F.array(F.concat(F.when(F.col("passed"), "- [x] ").otherwise("- [ ] "), F.col("check_name"))),
        F.transform("errors", lambda e: F.concat(F.lit("    - "), e)),
        F.transform("warnings", lambda w: F.concat(F.lit("    - warning: "), w)),
    )
    return checks.select(*SUBMISSION, "check_name", F.array_join(lines, "\n").alias("text"))


def validate(
    rows: DataFrame,
    files: DataFrame,
    truth: DataFrame,
    claims: DataFrame,
    owners: DataFrame,
    config: ValidationConfig = ValidationConfig(),
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """All checks of all submissions: the report of ``report``.

    ``rows`` belong to the files by ``path``; ``unreadable`` (path, problem) lists files that could not
    be parsed, which fail the content check and skip the index and integrity checks. Claims, owners, file verdicts
    and counters, one row per submission or file each, feed several checks and are staged once.
    """
    claims, owners = stage(claims.select(*SUBMISSION, "owner"), "claims"), stage(owners.select("model_id", "recorded_owner"), "owners")
    unreadable = stage(unreadable.select("path", "problem"), "unreadable") if unreadable is not None else None
    judged = stage(judge_files(files), "files")
    accepted = accepted_files(judged)
    opened = stage(opened_files(accepted, config, unreadable), "opened")
    fit = rows_of_files(rows, opened)
    sites = stage(site_profile(fit, truth, config), "site-profile")
    profile = stage(file_profile(sites, truth, opened), "profile")
    found = check_files(judged)
    if unreadable is not None:
        found = found.unionByName(check_readable(accepted, unreadable))
    for part in (
        check_sizes(accepted, config),
        check_content(profile, config),
        check_index(profile, index_examples(fit, truth, sites, profile)),
        check_integrity(profile, config),
        check_ownership(claims, owners),
    ):
        found = found.unionByName(part)
    return report(claims, found)
