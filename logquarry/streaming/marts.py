"""The cost and performance marts over arriving events: the same per-minute groups as windows with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.fixed_values import UNIT_COST
from logquarry.functions.columns import classify_service, clock, fill_unknown


def _windowed(events: DataFrame, delay: str):
    timed = events.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay)
    return timed, F.window("timestamp", "1 minute")


def _finish(counts: DataFrame, *columns) -> DataFrame:
    start = F.col("window.start")
    return counts.select(
        start.cast("timestamp_ntz").alias("timestamp"), F.to_date(start).alias("date"),
        clock(start).alias("hora_completa"), *columns,
    )


def stream_cost(events: DataFrame, delay: str = "10 minutes", unit_cost: float = UNIT_COST) -> DataFrame:
    """A minute's rows are emitted once the watermark has passed it (append mode)."""
    timed, minute = _windowed(events, delay)
    counts = timed.groupBy(minute, classify_service(F.col("event")).alias("service")).agg(
        F.count("*").alias("requests")
    )
    return _finish(counts, "service", "requests", F.bround(F.col("requests") * F.lit(unit_cost), 8).alias("cost"))


def stream_performance(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Exact user counts on a stream: count per (minute, user), then per minute, as two chained aggregations."""
    timed, minute = _windowed(events, delay)
    by_user = timed.groupBy(minute, fill_unknown(F.col("user_hash")).alias("user_hash")).agg(
        F.count("*").alias("requests")
    )
    per_minute = by_user.groupBy(F.window("window", "1 minute")).agg(
        F.sum("requests").alias("requests"), F.count("*").alias("unique_users")
    )
    return _finish(per_minute, "requests", "unique_users")
