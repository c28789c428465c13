"""Experiment names, file names and submitter identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skillgauge.schema import SETTINGS, TARGETS, VAL_STRATEGIES

# Fixed formats: {setting}_{target}_{model}_val_{strategy}[_predictions].csv
FILE_PATTERN = (
    f"^({'|'.join(SETTINGS)})_({'|'.join(TARGETS)})_(.*)_val_({'|'.join(VAL_STRATEGIES)})"
    "(_predictions)?[.]csv$"
)
MODEL_SLUG_PATTERN = "^[a-z0-9][a-z0-9_-]{0,48}$"
EMAIL_PATTERN = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parse_file_name(name: Column) -> Column:
    """Struct (setting, target, model, val_strategy, is_raw); NULL when the name does not match.

    One pass of the pattern: it rewrites a matching name to its parts, and a name that does not
    match stays a single part.
    """
    parts = F.split(F.regexp_replace(name, FILE_PATTERN, "$1\u0001$2\u0001$3\u0001$4\u0001$5"), "\u0001")
    part = lambda i: F.element_at(parts, i + 1)
    return F.when(
        F.size(parts) == 5,
        F.struct(
            part(0).alias("setting"),
            part(1).alias("target"),
            part(2).alias("model"),
            part(3).alias("val_strategy"),
            (part(4) != "").alias("is_raw"),
        ),
    )


def experiment_name(setting: Column, target: Column, model: Column, val_strategy: Column) -> Column:
    return F.concat(setting, F.lit("_"), target, F.lit("_"), model, F.lit("_val_"), val_strategy)


def metrics_file_name(setting: Column, target: Column, model: Column, val_strategy: Column) -> Column:
    return F.concat(experiment_name(setting, target, model, val_strategy), F.lit(".csv"))


def predictions_file_name(setting: Column, target: Column, model: Column, val_strategy: Column) -> Column:
    return F.concat(experiment_name(setting, target, model, val_strategy), F.lit("_predictions.csv"))


def is_model_slug(model_id: Column) -> Column:
    return F.coalesce(model_id.rlike(MODEL_SLUG_PATTERN), F.lit(False))


def clean_email(email: Column) -> Column:
    """Trimmed lower-case address; NULL when blank."""
    return F.nullif(F.lower(F.trim(email)), F.lit(""))


def is_email(email: Column) -> Column:
    return F.coalesce(clean_email(email).rlike(EMAIL_PATTERN), F.lit(False))


def owner_hash(token: Column) -> Column:
    """Hash of the owner token exactly as given."""
    return F.sha2(token.cast("binary"), 256)


def email_owner_hash(email: Column) -> Column:
    """Hash of the normalised address; NULL when blank."""
    return owner_hash(clean_email(email))
