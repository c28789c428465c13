"""Staged intake: the registry decides which submissions are checked at all.

The metadata check comes first and every document has its row of it. Only submissions that pass it go on to the
checks of files, content, index, truth and ownership; the rows of all others are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgauge.operators.registry import admitted, intake_gate, parse_registry, unreadable_documents
from skillgauge.operators.validation import CHECKS, SUBMISSION, ValidationConfig, report, validate
from skillgauge.sources.stores import stage

STAGES = ["metadata", *CHECKS]


def intake_report(
    registry: DataFrame, objects: DataFrame, rows: DataFrame, files: DataFrame, truth: DataFrame, owners: DataFrame,
    config: ValidationConfig = ValidationConfig(), unreadable: DataFrame | None = None,
) -> DataFrame:
    """The report of ``validation.report`` with ``metadata`` in front and ``stage``, the place of a check.

    ``registry`` is (path, doc), ``objects`` lists stored files by ``path``; the others are as for ``validate``. A submission
    that its metadata stop has the metadata row alone. Documents that cannot be read, and those without a model or
    strategy, are told under ``?``.
    """
    gate = stage(intake_gate(registry, objects), "gate")
    unknown = F.lit("?")
    told = parse_registry(registry).select(*[F.coalesce(c, unknown).alias(c) for c in SUBMISSION])
    told = told.unionByName(unreadable_documents(registry).select(*[unknown.alias(c) for c in SUBMISSION]))
    passed = stage(admitted(registry, gate).dropDuplicates(SUBMISSION), "admitted")
    ours = files.join(passed.select(*SUBMISSION), SUBMISSION, "left_semi")
    checked = validate(rows, ours, truth, passed, owners, config, unreadable)  # takes the rows of these files alone
    whole = report(told, gate, ["metadata"]).unionByName(checked)
    return whole.withColumn("stage", F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("check_name")).cast("bigint"))
