"""Call counts per client and hour on a stream, for watching the load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_counts(calls: DataFrame, limit: int, lateness: str = "2 hours") -> DataFrame:
    """Calls per client and hour window, and how many are over the limit.

    ``calls`` has (client, time) with ``time`` a timestamp. The watermark bounds the state.
    """
    return (
        calls.withWatermark("time", lateness)
        .groupBy("client", F.window("time", "1 hour").alias("hour"))
        .agg(F.count(F.lit(1)).alias("calls"))
        .select(
            "client", F.col("hour.start").alias("hour"), "calls",
            F.greatest(F.col("calls") - limit, F.lit(0)).alias("over_limit"),
        )
    )
