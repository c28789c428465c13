"""Error moments of site-days: the one pass over scored rows from which hourly metrics, day totals and coverage come.

A row holds, for one experiment, reporting unit, site and day, the sums that ``temporal.day_totals`` has, how many rows
have no truth, and count, sums, squares and co-moments of the errors. Rows of any number of days merge by adding up;
spreads are merged from centred squares, and a spread is zero when least and greatest value agree but for rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgauge.functions.metrics import ZERO_MEAN, ZERO_SPREAD, finite_pair
from skillgauge.functions.numeric import nan_to_null, ratio
from skillgauge.operators import temporal as ts
from skillgauge.schema import EXPERIMENT, METRICS


def site_days(rows: DataFrame, keys: Sequence[str] = EXPERIMENT) -> DataFrame:
    """One row per (experiment, env, site, day) of rows that carry the truth to score against."""
    yt, yp = F.col("y_true"), F.col("y_pred")
    error = nan_to_null(yp - yt)
    obs, pred = finite_pair(yt, yp)
    n = F.count(obs)
    return ts.day_totals(rows, keys, extra=[
        F.count_if(yt.isNull()).alias("unmatched"),
        F.count(error).alias("err_n"), F.sum(error).alias("err_sum"), F.sum(F.abs(error)).alias("err_abs"), F.sum(error * error).alias("err_sq"),
        n.alias("n"), F.sum(pred - obs).alias("diff_sum"), F.sum(F.abs(pred - obs)).alias("diff_abs"), F.sum((pred - obs) * (pred - obs)).alias("diff_sq"),
        F.sum(F.abs(obs)).alias("obs_abs"), F.sum(F.abs(pred)).alias("pred_abs"), F.avg(obs).alias("obs_mean"), F.avg(pred).alias("pred_mean"),
        (F.var_pop(obs) * n).alias("obs_m2"), (F.var_pop(pred) * n).alias("pred_m2"), (F.covar_pop(obs, pred) * n).alias("co_m2"),
        F.min(obs).alias("obs_min"), F.max(obs).alias("obs_max"), F.min(pred).alias("pred_min"), F.max(pred).alias("pred_max"),
    ])


def hourly_metrics(days: DataFrame, keys: Sequence[str] = EXPERIMENT, metrics: Sequence[str] = METRICS) -> DataFrame:
    """The hourly scale: per experiment and unit the number of rows and the metrics named, as ``functions.metrics`` defines them.

    Means come first, then the squares of the days about them: sums of plain squares would lose a small spread far from zero.
    """
    by = [*keys, "env"]
    own = days.where(F.col("env").isNotNull())
    total = lambda c: F.sum(c).cast("double").alias(c)
    sums = own.groupBy(*by).agg(
        F.sum("n_rows").alias("n_samples"), *[total(c) for c in ("n", "err_n", "err_sum", "err_abs", "err_sq", "diff_sum", "diff_abs", "diff_sq", "obs_abs", "pred_abs")],
        *[ratio(F.sum(F.col("n") * F.col(f"{c}_mean")), F.sum("n")).alias(f"{c}_all") for c in ("obs", "pred")],
        *[(F.min(f"{c}_min") < F.max(f"{c}_max")).alias(f"{c}_varies") for c in ("obs", "pred")])
    off = {c: F.col(f"{c}_mean") - F.col(f"{c}_all") for c in ("obs", "pred")}
    centred = own.select(*by, "n", "obs_mean", "pred_mean", "obs_m2", "pred_m2", "co_m2").join(sums.select(*by, "obs_all", "pred_all"), by).groupBy(*by).agg(
        F.sum(F.col("obs_m2") + F.col("n") * off["obs"] * off["obs"]).alias("obs_sq"),
        F.sum(F.col("pred_m2") + F.col("n") * off["pred"] * off["pred"]).alias("pred_sq"),
        F.sum(F.col("co_m2") + F.col("n") * off["obs"] * off["pred"]).alias("co"))
    mean = lambda c, n="n": ratio(F.col(c), F.col(n))
    spread = lambda c: F.when(F.col(f"{c}_varies") & (F.sqrt(mean(f"{c}_sq")) > F.lit(ZERO_SPREAD) * mean(f"{c}_abs")), mean(f"{c}_sq"))
    relative = lambda error: F.when(F.abs("obs_all") > F.lit(ZERO_MEAN) * mean("obs_abs"), ratio(error, F.col("obs_all")))
    r = ratio(mean("co"), F.sqrt(spread("obs")) * F.sqrt(spread("pred")))
    build = {
        "mse": mean("err_sq", "err_n"), "rmse": F.sqrt(mean("err_sq", "err_n")), "mae": mean("err_abs", "err_n"), "bias": -mean("err_sum", "err_n"),
        "nse": 1 - ratio(mean("diff_sq"), spread("obs")), "r2_score": r * r,
        "relative_mae": relative(mean("diff_abs")), "relative_bias": relative(-mean("diff_sum")),
    }
    return sums.join(centred, by).select(*keys, F.lit("hourly").alias("scale"), "env", "n_samples", *[nan_to_null(build[m].cast("double")).alias(m) for m in metrics])


def coverage_of(days: DataFrame, keys: Sequence[str] = EXPERIMENT) -> DataFrame:
    """Rows and rows outside the truth per experiment, as ``truth.coverage`` has them."""
    return days.groupBy(*keys).agg(F.sum("n_rows").alias("rows"), F.sum("unmatched").alias("unmatched")).withColumn("covered", F.col("unmatched") == 0)
