import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skillgauge.operators.quota import admit
from skillgauge.operators.ranking import exact_quantile, exact_quantiles, first_rows, value_ranges, value_ranks
from datetime import datetime, timedelta


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(5)
    data = [("small", rng.gauss(0, 1)) for _ in range(301)]
    data += [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-200, 200)) for _ in range(200)]
    data += [("tied", 2.0)] * 400 + [("tied", float(i)) for i in range(7)]
    data += [("zeros", -0.0), ("zeros", 0.0), ("zeros", None)] + [("one", 3.5)] + [("none", None)]
    return data, spark.createDataFrame(data, "g string, v double")


def test_quantiles_match_linear_interpolation(values):
    data, df = values
    for q in (0.0, 0.1, 0.5, 0.9, 1.0):
        out = {r.g: r.v for r in exact_quantile(df, ["g"], "v", q).collect()}
        for g in ("small", "wide", "tied", "zeros", "one"):
            own = [v for k, v in data if k == g and v is not None]
            assert out[g] == pytest.approx(np.quantile(own, q), rel=1e-9)
        assert "none" not in out


def test_ranks_follow_sorted_order(values):
    data, df = values
    for descending in (False, True):
        rows = value_ranks(df, ["g"], "v", descending).collect()
        for g in ("small", "wide", "tied"):
            own = sorted((v for k, v in data if k == g), reverse=descending)
            for r in (r for r in rows if r.g == g):
                assert own[r.first_rank] == r.v and own[r.first_rank + r.copies - 1] == r.v and r.total == len(own)


def test_several_quantiles_from_one_ranking(values):
    data, df = values
    shares = {"low": 0.1, "median": 0.5, "q90": 0.9, "last": 1.0}
    got = {(r.g, r.aggregate): r.value for r in exact_quantiles(df, ["g"], "v", shares).collect()}
    groups = {g for g, v in data if v is not None}
    assert set(got) == {(g, name) for g in groups for name in shares}
    for (g, name), value in got.items():
        assert value == pytest.approx(np.quantile([v for k, v in data if k == g and v is not None], shares[name]), rel=1e-9)


def test_close_values_of_one_group_are_split_over_tasks(spark):
    rng = random.Random(3)
    numbers = sorted({0.99 + rng.random() / 100 for _ in range(100_000)} | {float("inf"), float("-inf"), 5e-324, -5e-324, 0.0})
    rows = spark.createDataFrame([("hot", v) for v in numbers] + [("other", 0.995)], "g string, v double").repartition(4)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("false", "8")):  # small partitions stay apart, as those of a large table do
        spark.conf.set(k, v)
    try:
        ranges = value_ranges(rows, ["g"], "v").where("g = 'hot'").groupBy("range").agg(
            F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("range").collect()
        assert len(ranges) > 3 and max(r.n for r in ranges) < len(numbers) / 2
        assert all(a.high < b.low for a, b in zip(ranges, ranges[1:]))
        for q in (0.25, 0.5, 0.9):
            got = {r.g: r.v for r in exact_quantile(rows, ["g"], "v", q).collect()}
            want = {r.g: r.p for r in rows.groupBy("g").agg(F.percentile("v", q).alias("p")).collect()}
            assert got == pytest.approx(want, rel=1e-12)
        ranks = {r.v: r.first_rank for r in value_ranks(rows, ["g"], "v").where("g = 'hot'").collect()}
        assert ranks == {v: k for k, v in enumerate(numbers)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_first_rows_of_a_hot_group(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 == 0, "b").otherwise("a"))
    out = first_rows(df, ["g"], [F.col("id").desc()], 4, "id").collect()
    assert sorted(r.id for r in out if r.g == "b") == [4989, 4992, 4995, 4998]
    assert {r.place for r in out} == {1, 2, 3, 4} and len(out) == 8


def test_quota_counts_hourly_calls_that_the_day_rejects(spark):
    start = datetime(2024, 1, 1)
    calls = [(i, "x", start + timedelta(minutes=i)) for i in range(4)]
    calls += [(10, "y", start + timedelta(minutes=30)), (11, "y", start + timedelta(hours=1)), (12, "x", start + timedelta(hours=2))]
    df = spark.createDataFrame(calls, "call_id long, client string, time timestamp_ntz")
    out = {r.call_id: r.decision for r in admit(df, per_client_hour=2, per_day=3).collect()}
    assert out == {0: "admitted", 1: "admitted", 2: "hourly_limit", 3: "hourly_limit", 10: "admitted",
                   11: "daily_limit", 12: "daily_limit"}


def test_quota_against_a_counter(spark):
    rng = random.Random(11)
    start = datetime(2024, 1, 1)
    calls = [(i, f"c{rng.randrange(4)}", start + timedelta(minutes=rng.randrange(60 * 40))) for i in range(800)]
    hourly, daily, expected = {}, {}, {}
    for i, client, t in sorted(calls, key=lambda c: (c[2], c[0])):
        hour, day = (client, t.date(), t.hour), t.date()
        if hourly.get(hour, 0) >= 5:
            expected[i] = "hourly_limit"
            continue
        hourly[hour] = hourly.get(hour, 0) + 1
        if daily.get(day, 0) >= 200:
            expected[i] = "daily_limit"
            continue
        daily[day] = daily.get(day, 0) + 1
        expected[i] = "admitted"
    df = spark.createDataFrame(calls, "call_id long, client string, time timestamp_ntz")
    assert {r.call_id: r.decision for r in admit(df, 5, 200).collect()} == expected
