"""Column names, fixed dimensions and table schemas shared by every operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The four columns that identify one experiment (one prediction file).
EXPERIMENT = ["setting", "target", "model", "val_strategy"]

# Columns every prediction table must carry besides the experiment keys.
PREDICTION_COLUMNS = ["y_true", "y_pred", "env", "site_id", "time"]

# --- fixed values (must equal the benchmark definition) -----------------------
SETTINGS = ["time-split", "spatial-easy40", "TA40"]
TARGETS = ["GPP", "ET", "NEE"]
VAL_STRATEGIES = ["mean", "max", "discrepancy"]
SCALES = ["hourly", "daily", "weekly", "monthly", "seasonal", "anom", "iav", "spatial"]
MULTI_YEAR_SCALES = ["seasonal", "anom", "iav"]
METRICS = ["mse", "rmse", "mae", "nse", "r2_score", "bias", "relative_mae", "relative_bias"]
HIGHER_IS_BETTER = ["nse", "r2_score", "pearson_corr"]
LEADERBOARD_SCALES = ["hourly", "daily", "weekly", "monthly", "seasonal", "anom", "iav"]
DROPPED_SCALES = ["daily", "monthly"]
SETTING_LABELS = {"time-split": "temporal", "spatial-easy40": "spatial", "TA40": "temperature"}
SCALE_WEIGHTS = {
    "hourly": 1.0, "daily": 1.0, "weekly": 1.0, "monthly": 1.0,
    "seasonal": 1.0, "anom": 1.0, "iav": 1.0, "site-mean": 1.0,
}
MODEL_ORDER = [
    "xgb", "lightgbm", "mlp", "gdro", "coral", "mmd",
    "lr", "robust-lr", "ridge", "constant",
]
SETTINGS_ORDER = [
    "time-split", "spatial-easy40", "TA40", "spatial-easy", "spatial-hard",
    "LST", "TA", "VPD", "PFT_CRO", "PFT_ENF", "PFT_GRA", "PFT_WET",
    "forest", "grass-savanna", "schrub-savanna", "europe", "rest-of-world",
    "hard-1", "hard-2", "hard-3", "hard-4", "hard-5", "time-space",
]
# ------------------------------------------------------------------------------

TRUTH_SCHEMA = T.StructType([
    T.StructField("setting", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("site_id", T.StringType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("y_true", T.DoubleType()),
])

PREDICTION_SCHEMA = T.StructType(
    [T.StructField(k, T.StringType()) for k in EXPERIMENT]
    + [
        T.StructField("y_true", T.DoubleType()),
        T.StructField("y_pred", T.DoubleType()),
        T.StructField("env", T.StringType()),
        T.StructField("site_id", T.StringType()),
        T.StructField("time", T.TimestampNTZType()),
    ]
)

METRICS_SCHEMA = T.StructType(
    [T.StructField(k, T.StringType()) for k in ["target", "setting", "model", "val_strategy", "scale", "env"]]
    + [T.StructField("n_samples", T.LongType())]
    + [T.StructField(m, T.DoubleType()) for m in METRICS]
)


def listed_position(col: Column, listed: list[str]) -> Column:
    """1-based place of ``col`` in ``listed``; values outside the list share the last place."""
    place = F.array_position(F.array(*[F.lit(v) for v in listed]), col)
    return F.when(place > 0, place).otherwise(F.lit(len(listed) + 1)).cast("int")


def listed_first(col: Column, listed: list[str]) -> list[Column]:
    """Sort columns: listed values in the given order, then the rest alphabetically."""
    return [listed_position(col, listed).asc(), col.asc()]


def required_combos() -> Column:
    """Array of every (setting, target) struct a complete submission covers."""
    return F.array(*[
        F.struct(F.lit(s).alias("setting"), F.lit(t).alias("target"))
        for s in SETTINGS for t in TARGETS
    ])


def with_required_combos(df: DataFrame) -> DataFrame:
    """Repeat each row once per required (setting, target)."""
    return df.select("*", F.inline(required_combos()))


def with_experiment(df: DataFrame, **keys: str) -> DataFrame:
    """Attach constant experiment keys to a frame that holds a single experiment."""
    for name, value in keys.items():
        df = df.withColumn(name, F.lit(value))
    return df
