"""Fixed-window admission: at most so many calls per client and hour, and per day overall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgauge.operators.ranking import first_rows

# Fixed values of the service.
PER_CLIENT_HOUR = 10
PER_DAY = 50


def admit(calls: DataFrame, per_client_hour: int = PER_CLIENT_HOUR, per_day: int = PER_DAY) -> DataFrame:
    """``calls`` (call_id, client, time) with ``decision``: admitted, hourly_limit or daily_limit.

    The hourly test runs first and counts also when the daily test rejects; a rejected call is
    not counted by the test that rejects it. Ties in time go by ``call_id``.
    """
    order = [F.col("time"), F.col("call_id")]
    moment = F.struct("time", "call_id")
    hour = ["client", "day", "hour"]
    timed = calls.withColumn("day", F.col("time").cast("date")).withColumn("hour", F.hour("time"))
    hourly = first_rows(timed, hour, order, per_client_hour, "call_id").drop("place")
    daily = first_rows(hourly, ["day"], order, per_day, "call_id")
    # The last call within each limit is its cut-off; calls are compared with it, not looked up one by one.
    hour_cuts = hourly.groupBy(*[F.col(c).alias(f"cut_{c}") for c in hour]).agg(F.max(moment).alias("hour_cut"))
    day_cuts = daily.groupBy(F.col("day").alias("of_day")).agg(F.max(moment).alias("day_cut"))
    same = lambda c: F.col(c).eqNullSafe(F.col(f"cut_{c}"))
    cut = timed.join(hour_cuts, same("client") & same("day") & same("hour")).join(day_cuts, F.col("day").eqNullSafe(F.col("of_day")))
    return cut.withColumn(
        "decision",
        F.when(moment > F.col("hour_cut"), "hourly_limit").when(moment > F.col("day_cut"), "daily_limit").otherwise("admitted"),
    ).select(*calls.columns, "day", "hour", "decision")
