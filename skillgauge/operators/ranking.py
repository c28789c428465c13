"""Exact order statistics that split a group over tasks by ranges of value.

A cell of the leaderboard may hold any number of values, and one cell may hold a large share of
all of them. Instead of sorting a cell in one place, values are

1. collapsed to distinct values with counts (combined before the shuffle, so repeated values
   cost nothing),
2. dealt out in ranges of (group, value) whose bounds Spark samples from the values themselves, so that a
   group gets as many ranges as its share of the rows, however close its values lie,
3. ranked inside their range and offset by the counts of the group's ranges before it.

The ranges are written once with their number, so that every later step, and every retry, sees the same
ones. Only counts of ranges are ever brought together per group: one row for each range a group lies in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillgauge.sources.stores import stage


def value_ranges(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Distinct values per group with their ``copies`` and the number of their ``range``, which grows with group and value."""
    distinct = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, (F.col(value) + F.lit(0.0)).alias(value))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return stage(distinct.repartitionByRange(*by, value).withColumn("range", F.spark_partition_id()), "value-ranges")


def value_ranks(df: DataFrame, by: Sequence[str], value: str, descending: bool = False) -> DataFrame:
    """Distinct values per group: ``(by, value, copies, first_rank, total)``, ranks from 0.

    The copies of a value take ranks ``first_rank .. first_rank + copies - 1``. NULLs are left out.
    """
    ranges = value_ranges(df, by, value)
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    whole, before = W.partitionBy(*by), W.partitionBy(*by).orderBy(direction("range"))
    offsets = (
        ranges.groupBy(*by, "range")
        .agg(F.sum("copies").alias("in_range"))
        .select(
            *by, "range",
            (F.sum("in_range").over(before) - F.col("in_range")).alias("offset"),
            F.sum("in_range").over(whole).alias("total"),
        )
    )
    inside = W.partitionBy(*by, "range").orderBy(direction(value))
    ranked = ranges.withColumn(
        "inside", F.sum("copies").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("copies")
    )
    return ranked.join(offsets, [*by, "range"]).select(
        *by, value, "copies", (F.col("offset") + F.col("inside")).alias("first_rank"), "total"
    )


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, shares: Mapping[str, float]) -> DataFrame:
    """Linearly interpolated quantiles per group from one ranking: ``(by, aggregate, value)``, a row for each
    name in ``shares``; groups without a value do not appear."""
    places = F.array(*[
        F.struct(F.lit(name).alias("aggregate"), ((F.col("total") - 1) * F.lit(float(share))).alias("position"))
        for name, share in shares.items()
    ])
    holds = lambda r: (F.col("first_rank") <= r) & (r < F.col("first_rank") + F.col("copies"))
    # The value's own places among the wanted ones; nearly all values have none and are not spread.
    wanted = F.filter(places, lambda p: holds(F.floor(p.position)) | holds(F.ceil(p.position)))
    picked = value_ranks(df, by, value).select(*by, F.col(value).alias("own"), "first_rank", "copies", F.inline(wanted))
    low, high = F.floor("position"), F.ceil("position")
    return picked.groupBy(*by, "aggregate").agg(
        F.max(F.when(holds(low), F.col("own"))).alias("lower"), F.max(F.when(holds(high), F.col("own"))).alias("upper"),
        F.max(F.col("position") - low).alias("part"),
    ).select(
        *by, "aggregate",
        # Equal ends also keep two infinities from becoming NaN.
        F.when(F.col("lower") == F.col("upper"), F.col("lower"))
        .otherwise(F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("part"))
        .alias("value"),
    )


def exact_quantile(
    df: DataFrame, by: Sequence[str], value: str, share: float, name: str | None = None
) -> DataFrame:
    """One linearly interpolated quantile per group; groups without a value do not appear."""
    return exact_quantiles(df, by, value, {"one": share}).select(*by, F.col("value").alias(name or value))


def first_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, spread_by: str, slots: int = 64
) -> DataFrame:
    """The first ``n`` rows of every group, with their place in ``place``.

    Groups are cut to ``n`` rows per slot first, so the last step sees at most ``slots * n`` rows
    of one group.
    """
    slot = F.pmod(F.xxhash64(spread_by), F.lit(slots))
    near = W.partitionBy(*by, "slot").orderBy(*order)
    final = W.partitionBy(*by).orderBy(*order)
    cut = df.withColumn("slot", slot).withColumn("place", F.row_number().over(near)).where(F.col("place") <= n)
    return cut.drop("slot").withColumn("place", F.row_number().over(final)).where(F.col("place") <= n)
