"""Windows over ranges of an order against one window over everything."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from logquarry.operators import features, rolling


def columns(window):
    latest = window.rowsBetween(-4, 0)
    return {"total": F.sum("v").over(latest), "least": F.min("v").over(latest), "fourth": F.lag("i", 4).over(window)}


def both(df, ranges):
    found = rolling.over_ranges(df, ["k", "i"], 4, columns, ranges)
    whole = df.withColumns(columns(Window.orderBy(F.col("k").asc_nulls_first(), "i")))
    assert found.columns == whole.columns
    return sorted(found.collect(), key=lambda r: r.i), sorted(whole.collect(), key=lambda r: r.i)


@pytest.mark.parametrize("ranges", [1, 3, 16, 64])
def test_ranges_equal_one_window(spark, ranges):
    """A hot key, nulls, ranges of fewer rows than the halo, and columns with the operator's own names."""
    rng = random.Random(ranges)
    rows = [(i, None if i % 50 == 0 else 7 if i % 3 == 0 else rng.randrange(20), rng.randrange(100), i, "own") for i in range(300)]
    found, whole = both(spark.createDataFrame(rows, "i long, k int, v long, part int, own string").repartition(5), ranges)
    assert found == whole


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    found, whole = both(spark.createDataFrame([(i, 1, i) for i in range(n)], "i long, k int, v long"), 8)
    assert found == whole


def test_no_task_takes_all_rows(spark):
    df = spark.range(20_000).selectExpr("id AS i", "1 AS k", "id AS v")
    found = rolling.over_ranges(df, ["k", "i"], 4, columns, 8)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert sum(sizes) == 20_000 and max(sizes) < 15_000 and "hashpartitioning(range of the order" in text


def test_trend_reaches_the_feature_table(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=i), n, 1) for i, n in enumerate((4, 0, 6, 3))]
    mart = spark.createDataFrame(rows, "timestamp timestamp_ntz, requests long, unique_users long")
    trend = sorted(rolling.request_trend(mart).collect(), key=lambda r: r.timestamp)
    assert [r.rolling_requests_3 for r in trend] == [4.0, 2.0, 10 / 3, 3.0]
    assert [r.requests_growth_pct for r in trend] == [0.0, -100.0, 0.0, -50.0]
    rolled = features.with_ratio_features(features.performance_rollup(rolling.request_trend(mart))).orderBy("timestamp").collect()
    assert [r.requests_vs_rolling_ratio for r in rolled] == [1.0, 0.0, pytest.approx(1.8), 1.0]
