"""Error metrics as aggregate Columns over an observed and a predicted column.

Every builder takes ``(yt, yp)`` and returns one aggregate Column, so any number of metrics is
computed in a single partial + final aggregation and a hot group is combined before it is
shuffled. Missing pairs drop out through NULL semantics. A spread that is zero but for rounding
(``ZERO_SPREAD``) is zero, so a constant series gives NULL also when its values are sums or means.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from skillgauge.functions.numeric import is_finite, nan_to_null, ratio

Metric = Callable[[Column, Column], Column]


def _error(yt: Column, yp: Column) -> Column:
    return nan_to_null(yp - yt)


def finite_pair(yt: Column, yp: Column) -> tuple[Column, Column]:
    both = is_finite(yt) & is_finite(yp)
    return F.when(both, yt), F.when(both, yp)


def mse(yt: Column, yp: Column) -> Column:
    return F.avg(_error(yt, yp) * _error(yt, yp))


def rmse(yt: Column, yp: Column) -> Column:
    return F.sqrt(mse(yt, yp))


def mae(yt: Column, yp: Column) -> Column:
    return F.avg(F.abs(_error(yt, yp)))


def bias(yt: Column, yp: Column) -> Column:
    """Observed minus predicted."""
    return F.avg(-_error(yt, yp))


# A mean this small beside the mean size of its values is zero but for rounding, as that of anomalies is.
ZERO_MEAN = 1e-9


def _relative(error: Column, obs: Column) -> Column:
    """``error`` over the signed mean of the observations; NULL where that mean is zero."""
    mean = F.avg(obs)
    return F.when(F.abs(mean) > F.lit(ZERO_MEAN) * F.avg(F.abs(obs)), ratio(error, mean))


def relative_mae(yt: Column, yp: Column) -> Column:
    obs, pred = finite_pair(yt, yp)
    return _relative(F.avg(F.abs(pred - obs)), obs)


def relative_bias(yt: Column, yp: Column) -> Column:
    obs, pred = finite_pair(yt, yp)
    return _relative(F.avg(-(pred - obs)), obs)


# Equal values that were added up in different orders differ by a few 1e-16 of their size.
ZERO_SPREAD = 1e-12


def _variance(col: Column) -> Column:
    """The variance of a column, NULL where it does not vary."""
    return F.when(F.sqrt(F.var_pop(col)) > F.lit(ZERO_SPREAD) * F.avg(F.abs(col)), F.var_pop(col))


def nse(yt: Column, yp: Column) -> Column:
    """One minus residual over total variance; NULL when the observations do not vary."""
    obs, pred = finite_pair(yt, yp)
    return 1 - ratio(F.avg((pred - obs) * (pred - obs)), _variance(obs))


def r2_score(yt: Column, yp: Column) -> Column:
    """Squared Pearson correlation; NULL when either side does not vary."""
    obs, pred = finite_pair(yt, yp)
    r = ratio(F.covar_pop(obs, pred), F.sqrt(_variance(obs)) * F.sqrt(_variance(pred)))
    return r * r


DEFAULT_METRICS: dict[str, Metric] = {
    "mse": mse,
    "rmse": rmse,
    "mae": mae,
    "nse": nse,
    "r2_score": r2_score,
    "bias": bias,
    "relative_mae": relative_mae,
    "relative_bias": relative_bias,
}


def metric_columns(metrics: dict[str, Metric], yt: Column, yp: Column) -> list[Column]:
    return [nan_to_null(build(yt, yp).cast("double")).alias(name) for name, build in metrics.items()]
