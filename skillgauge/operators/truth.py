"""The canonical truth table: build, manifest, assertions, verification and the truth join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgauge.functions.numeric import is_finite
from skillgauge.schema import EXPERIMENT, SETTINGS, TARGETS, required_combos

TRUTH_KEYS = ["setting", "target", "site_id", "time"]
COMBO = ["setting", "target"]


def truth_from_predictions(predictions: DataFrame, model: str = "lr", val_strategy: str = "mean") -> DataFrame:
    """Truth rows of the trusted baseline; its rows define the values and the required keys."""
    trusted = predictions.where((F.col("model") == model) & (F.col("val_strategy") == val_strategy))
    return trusted.select(*TRUTH_KEYS, "y_true")


def truth_manifest(truth: DataFrame) -> DataFrame:
    """One row per (setting, target): rows, sites and time span."""
    # Two plain aggregations instead of a distinct count per combo: sites are reduced per
    # (combo, site) first, so a combo with most of the rows is never expanded in one task.
    per_site = truth.groupBy(*COMBO, "site_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("time").alias("time_min"), F.max("time").alias("time_max"),
    )
    return per_site.groupBy(*COMBO).agg(
        F.sum("rows").alias("rows"),
        F.count("site_id").alias("sites"),
        F.min("time_min").alias("time_min"),
        F.max("time_max").alias("time_max"),
    )


def truth_fingerprint(truth: DataFrame) -> DataFrame:
    """Per (setting, target) a text that any changed, added or lost row changes, whatever the order of rows: the sums of
    two 64-bit hashes of each row. Sums of parts add up, so it needs no second pass and no sorting."""
    hashes = [F.xxhash64(F.lit(k), *TRUTH_KEYS, "y_true").cast("decimal(20,0)") for k in (1, 2)]
    return truth.groupBy(*COMBO).agg(F.concat_ws(":", *[F.sum(h).cast("string") for h in hashes]).alias("fingerprint"))


def full_manifest(truth: DataFrame, model: str = "lr", val_strategy: str = "mean") -> DataFrame:
    """``truth_manifest`` with the fingerprint, the rows of the whole table and what the truth was taken from."""
    combos = truth_manifest(truth).join(truth_fingerprint(truth), COMBO)
    whole = truth.agg(F.count(F.lit(1)).alias("total_rows"))
    return combos.crossJoin(whole).select(*combos.columns, "total_rows", F.lit(model).alias("truth_model"), F.lit(val_strategy).alias("val_strategy"))


def truth_assertions(truth: DataFrame) -> DataFrame:
    """Per required (setting, target): rows, repeated keys, non-finite values, and whether it is fit.

    Every required combo has a row, also when the truth lacks it.
    """
    per_key = truth.groupBy(*TRUTH_KEYS).agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(~F.coalesce(is_finite(F.col("y_true")), F.lit(False))).alias("non_finite"),
    )
    per_combo = per_key.groupBy(*COMBO).agg(
        F.sum("copies").alias("rows"),
        F.sum(F.col("copies") - 1).alias("duplicates"),
        F.sum("non_finite").alias("non_finite"),
    )
    required = truth.sparkSession.range(1).select(F.inline(required_combos()))
    counts = ["rows", "duplicates", "non_finite"]
    return (
        required.join(per_combo, COMBO, "left")
        .na.fill(0, counts)
        .withColumn(
            "passed", (F.col("rows") > 0) & (F.col("duplicates") == 0) & (F.col("non_finite") == 0)
        )
    )


def assert_truth(truth: DataFrame) -> None:
    """Raise when the truth is unfit. Looks at one row per required combo only."""
    bad = truth_assertions(truth).where(~F.col("passed")).take(len(SETTINGS) * len(TARGETS))
    if bad:
        raise ValueError("truth table is unfit: " + "; ".join(
            f"{r.setting}/{r.target}: {r.rows} rows, {r.duplicates} duplicate keys, {r.non_finite} non-finite"
            for r in bad
        ))


def verify_manifest(truth: DataFrame, manifest: DataFrame) -> DataFrame:
    """Recorded against recomputed statistics per combo; a combo on one side only fails."""
    columns = ["rows", "sites", "time_min", "time_max", "fingerprint"]
    recorded = [c for c in columns if c in manifest.columns]
    now = truth_manifest(truth)
    if "fingerprint" in recorded:
        now = now.join(truth_fingerprint(truth), COMBO)
    now = now.select(*COMBO, *[F.col(c).alias(f"{c}_now") for c in columns if c in now.columns])
    joined = manifest.select(*COMBO, *recorded).join(now, COMBO, "full_outer")
    same = F.lit(True)
    for c in recorded:
        equal = F.col(c).eqNullSafe(F.col(f"{c}_now"))
        same = same & (equal | (F.col(c).isNull() & F.col("rows").isNotNull()) if c == "fingerprint" and "rows" in recorded else equal)
    return joined.withColumn("matches", same)


def truth_slice(truth: DataFrame, setting: str, target: str) -> DataFrame:
    """One (setting, target) of the truth; only that partition is read. Raises when it is empty."""
    part = truth.where((F.col("setting") == setting) & (F.col("target") == target)).select(
        "site_id", "time", "y_true"
    )
    if part.isEmpty():
        raise ValueError(f"truth table has no rows for {setting}/{target}")
    return part


def canonical_truth(truth: DataFrame) -> DataFrame:
    """Truth rows with unique keys; a repeated key raises when its row is read. The check groups by
    the keys of the join, so it shares the join's shuffle."""
    repeated = F.raise_error(F.concat(F.lit("truth key repeated: "), F.concat_ws("/", *[F.col(k).cast("string") for k in TRUTH_KEYS])))
    return truth.groupBy(*TRUTH_KEYS).agg(F.max("y_true").alias("y_max"), F.count(F.lit(1)).alias("copies")).select(
        *TRUTH_KEYS, F.when(F.col("copies") > 1, repeated.cast("double")).otherwise(F.col("y_max")).alias("y_true"))


def join_truth(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Replace the submitted truth by the canonical one; unmatched rows keep a NULL truth. A
    repeated truth key raises, so no row is multiplied."""
    return predictions.drop("y_true").join(canonical_truth(truth), TRUTH_KEYS, "left")


def coverage(joined: DataFrame) -> DataFrame:
    """Rows and rows outside the truth per experiment; any such row makes scoring fail."""
    return joined.groupBy(*EXPERIMENT).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("y_true").isNull()).alias("unmatched"),
    ).withColumn("covered", F.col("unmatched") == 0)


def score_against_truth(predictions: DataFrame, truth: DataFrame, require_full_coverage: bool = True, **options) -> DataFrame:
    """Metrics of every experiment on canonical truth; experiments with uncovered rows are left out."""
    from skillgauge.operators.scoring import metrics_and_coverage
    from skillgauge.sources.stores import stage

    def covered(found: DataFrame) -> DataFrame:
        return stage(found.where("covered").select(*EXPERIMENT), "covered")  # of known size: the rows are not shuffled by experiment

    if require_full_coverage:
        options["chosen"] = covered
    return metrics_and_coverage(join_truth(predictions, truth), **options)[0]
