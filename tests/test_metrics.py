from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skillgauge.operators.cleaning import clean_predictions
from skillgauge.operators.scoring import compute_metrics, sample_sizes
from tests.helpers import series


def score(spark, pairs, **kw):
    rows = [("a", "a", datetime(2020, 1, 1) + timedelta(hours=i), t, p) for i, (t, p) in enumerate(pairs)]
    return compute_metrics(clean_predictions(series(spark, rows)), scales=["hourly"], **kw).collect()[0]


def test_hand_computed(spark):
    m = score(spark, [(1, 2), (2, 2), (3, 5), (6, 4)])
    assert m.n_samples == 4
    assert m.mse == pytest.approx((1 + 0 + 4 + 4) / 4) and m.rmse == pytest.approx(1.5)
    assert m.mae == pytest.approx(5 / 4) and m.bias == pytest.approx(-1 / 4)
    assert m.relative_mae == pytest.approx(5 / 12) and m.relative_bias == pytest.approx(-1 / 12)
    assert m.nse == pytest.approx(1 - 9 / 14)
    # Deviations (-2, -1, 0, 3) and (-1.25, -1.25, 1.75, 0.75): products sum to 6.
    assert m.r2_score == pytest.approx(36 / (14 * 6.75))


def test_missing_pairs_count_as_samples_only(spark):
    m = score(spark, [(1, 2), (None, 5), (3, float("nan"))])
    assert m.n_samples == 3 and m.mse == 1.0


def test_constant_truth(spark):
    m = score(spark, [(2, 1), (2, 3)])
    assert m.nse is None and m.r2_score is None and m.rmse == 1.0


def test_constant_awkward_value(spark):
    m = score(spark, [(0.1, i) for i in range(7)])
    assert m.nse is None and m.r2_score is None


def test_zero_mean_truth(spark):
    m = score(spark, [(-1, 0), (1, 0)])
    assert m.relative_mae is None and m.relative_bias is None and m.mae == 1.0


def test_infinite_prediction(spark):
    m = score(spark, [(1, float("inf")), (2, 3), (4, 3)])
    assert m.mse == float("inf") and m.nse == pytest.approx(0.0) and m.relative_mae == pytest.approx(1 / 3)


def test_all_missing(spark):
    m = score(spark, [(None, 1), (None, 2)])
    assert m.n_samples == 2 and all(m[k] is None for k in ("mse", "rmse", "mae", "nse", "r2_score", "bias"))


def test_single_pair(spark):
    m = score(spark, [(1, 2)])
    assert m.nse is None and m.r2_score is None and m.mae == 1.0


def test_custom_metric_and_sizes(spark):
    m = score(spark, [(1, 2), (2, 5)], metrics={"worst": lambda yt, yp: F.max(F.abs(yp - yt))})
    assert m.worst == 3.0
    rows = [("a", "a", datetime(2020, 1, 1), 1, 2), ("b", "b", datetime(2020, 1, 1), 1, 2), ("b", "b", datetime(2020, 1, 2), 1, 2)]
    s = sample_sizes(compute_metrics(series(spark, rows), scales=["hourly"])).collect()[0]
    assert (s.groups, s.min_samples, s.mean_samples, s.max_samples) == (2, 1, 1.5, 2)


def test_spread_of_rounding_is_none(spark):
    """Means that are equal but for the order in which they were added up: the series does not vary."""
    level = [0.1 + 0.2, 0.3, 0.3]
    m = score(spark, list(zip([1, 2, 4], level)))
    assert m.r2_score is None and m.nse is not None
    m = score(spark, list(zip(level, [1, 2, 4])))
    assert m.r2_score is None and m.nse is None
    m = score(spark, [(1e6 + 1e-5, 1), (1e6, 2), (1e6, 4)])  # small, but a spread
    assert m.nse is not None and 0 < m.r2_score <= 1
