"""Small builders for prediction series."""

from datetime import datetime, timedelta

from skillgauge.schema import PREDICTION_SCHEMA

EXP = ("time-split", "GPP", "demo", "mean")


def series(spark, rows, exp=EXP):
    """``rows`` are (env, site_id, time, y_true, y_pred)."""
    data = [(*exp, None if yt is None else float(yt), None if yp is None else float(yp), env, site, t)
            for env, site, t, yt, yp in rows]
    return spark.createDataFrame(data, PREDICTION_SCHEMA)


def hours(env, day, n, y_true, y_pred, site=None):
    start = datetime.fromisoformat(day)
    return [(env, site or env, start + timedelta(hours=h), y_true, y_pred) for h in range(n)]


def days(env, first, n, y_true, y_pred, site=None):
    """One noon row per day; values may be functions of the date."""
    start = datetime.fromisoformat(first) + timedelta(hours=12)
    at = lambda v, t: v(t) if callable(v) else v
    return [(env, site or env, t, at(y_true, t), at(y_pred, t)) for t in (start + timedelta(days=i) for i in range(n))]


def by(frame, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in frame.collect()}
