"""Submission registry: metadata schema, intake gate and recorded owners.

A registry is a table ``(path, doc)`` with one JSON document per submission. Key presence is
read from the document itself, so a field that is present but null is told from an absent one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.operators.validation import SUBMISSION, messages
from skillgauge.sources.stores import stage

# --- fixed values ---------------------------------------------------------------------
TOP_FIELDS = [
    "model_id", "display_name", "email", "description", "code_url", "paper_url",
    "owner", "val_strategy", "submitted_at", "is_baseline", "status",
]
CORE_FILE_FIELDS = ["filename", "setting", "target"]
STAGE_FIELDS = {"pending": ["r2_key"], "scored": ["sha256"]}
# --------------------------------------------------------------------------------------


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


_DOCUMENT = "struct<" + ",".join(f"{k}:string" for k in [*TOP_FIELDS, "val_strategy_display"]) + ",files:array<string>>"


def parse_registry(registry: DataFrame) -> DataFrame:
    """Document fields as columns, ``files`` as an array of JSON texts; unreadable documents drop out
    (``unreadable_documents`` lists them). Each document is read once for its fields and once for the
    names of its keys."""
    return _documents(registry.where(F.json_object_keys("doc").isNotNull()))


def _documents(registry: DataFrame) -> DataFrame:
    """``parse_registry`` with the unreadable documents, which have no ``present``."""
    return registry.withColumn("d", F.from_json("doc", _DOCUMENT)).select(
        "path", "doc", *[F.col(f"d.{k}").alias(k) for k in [*TOP_FIELDS, "val_strategy_display"]],
        F.json_object_keys("doc").alias("present"), F.col("d.files").alias("files"),
    )


def unreadable_documents(registry: DataFrame) -> DataFrame:
    """Paths of documents that are no JSON object."""
    return registry.where(F.json_object_keys("doc").isNull()).select("path")


def schema_problems(parsed: DataFrame) -> DataFrame:
    """Attach ``problems``: texts for missing fields, unknown status, empty files, missing file fields."""
    status = F.col("status")
    absent = F.array_except(_texts(TOP_FIELDS), F.col("present"))
    required = F.when(status == "pending", _texts(CORE_FILE_FIELDS + STAGE_FIELDS["pending"])).when(
        status == "scored", _texts(CORE_FILE_FIELDS + STAGE_FIELDS["scored"])
    ).otherwise(_texts(CORE_FILE_FIELDS))
    quoted = lambda c: F.coalesce(F.concat(F.lit("'"), c, F.lit("'")), F.lit("None"))
    no_files = F.coalesce(F.size("files"), F.lit(0)) <= 0
    file_texts = F.flatten(F.transform("files", lambda f: F.transform(
        F.array_except(F.col("required"), F.coalesce(F.json_object_keys(f), _texts([]))),
        lambda k: F.concat(F.lit("file "), quoted(F.get_json_object(f, "$.filename")), F.lit(" lacks the field "), k),
    )))
    return parsed.withColumn("required", required).withColumn("problems", F.concat(
        F.transform(absent, lambda k: F.concat(F.lit("lacks the field "), k)),
        F.when(~F.coalesce(status.isin(list(STAGE_FIELDS)), F.lit(False)),
               F.array(F.concat(F.lit("unknown status "), quoted(status)))).otherwise(_texts([])),
        F.when(no_files, _texts(["lists no files"])).otherwise(file_texts),
    )).drop("required", "present")


def registry_files(parsed: DataFrame) -> DataFrame:
    """One row per file entry: submission, position, name and object key."""
    return parsed.select(
        *SUBMISSION, "owner", F.posexplode("files").alias("position", "entry")
    ).select(
        *SUBMISSION, "owner", "position",
        *[F.get_json_object("entry", f"$.{k}").alias(k) for k in ["filename", "setting", "target", "r2_key", "sha256"]],
    )


def intake_gate(registry: DataFrame, objects: DataFrame) -> DataFrame:
    """Messages of the ``metadata`` check. A submission with any message stops here; the others go
    on to the file checks. ``objects`` lists stored files by ``path``.

    Objects are looked up only for documents without schema problems, and the first absent one in
    file order is named. What is read from the documents is staged: filters on it would be pushed below the
    reading and would read each document again, once for every field they look at.
    """
    judged = schema_problems(_documents(registry).withColumn("readable", F.col("present").isNotNull()))
    pending = F.coalesce(F.col("status") == "pending", F.lit(False))
    judged = judged.withColumn("problems", F.concat(
        "problems", F.when(~pending, _texts(["only a `pending` submission can be taken in"])).otherwise(_texts([]))
    ))
    whole = stage(judged.select(
        "path", F.coalesce("model_id", F.lit("?")).alias("model_id"), F.coalesce("val_strategy", F.lit("?")).alias("val_strategy"),
        "problems", "files", "owner", "readable",
    ), "documents")
    shown = whole.where("readable")
    faults = shown.select(*SUBMISSION, F.explode("problems").alias("message"))
    listed = registry_files(shown.where(F.size("problems") == 0))
    # A key that is null finds no object and is named None.
    absent = (
        listed.join(objects.select(F.col("path").alias("r2_key")), "r2_key", "left_anti")
        .groupBy(*SUBMISSION)
        .agg(F.min_by(F.coalesce("r2_key", F.lit("None")), "position").alias("r2_key"))
        .select(*SUBMISSION, F.concat(F.lit("no stored object for `"), "r2_key", F.lit("`")).alias("message"))
    )
    broken = whole.where("not readable").select(
        F.lit("?").alias("model_id"), F.lit("?").alias("val_strategy"),
        F.concat(F.lit("cannot be read: "), F.coalesce("path", F.lit("-"))).alias("message"))
    return messages(faults.unionByName(absent).unionByName(broken), "metadata", text=F.col("message"))


def admitted(registry: DataFrame, gate: DataFrame) -> DataFrame:
    """Submissions that passed the intake gate, with their owner."""
    parsed = parse_registry(registry).select(*SUBMISSION, "owner")
    return parsed.join(gate.select(*SUBMISSION).distinct(), SUBMISSION, "left_anti")


def recorded_owners(registry: DataFrame) -> DataFrame:
    """Owner of each model: that of its first registry path, over all strategies."""
    return parse_registry(registry).where(F.col("model_id").isNotNull()).groupBy("model_id").agg(
        F.min_by("owner", "path").alias("recorded_owner")
    )


def display_labels(registry: DataFrame) -> DataFrame:
    """Label table of the leaderboard; documents without model or strategy are skipped."""
    return parse_registry(registry).where(
        (F.coalesce("model_id", F.lit("")) != "") & (F.coalesce("val_strategy", F.lit("")) != "")
    ).select(*SUBMISSION, "display_name", "val_strategy_display")


def pending(registry: DataFrame) -> DataFrame:
    return parse_registry(registry).where(F.col("status") == "pending").select(*SUBMISSION, "path", "owner")
