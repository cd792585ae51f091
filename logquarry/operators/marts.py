"""Cleaned events to the three per-minute marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.fixed_values import UNIT_COST
from logquarry.functions.columns import (
    classify_service, clock, fill_unknown, off_hours_flag, parse_utc, risk_level, time_bucket,
)
from logquarry.functions.names import drop_null, normalize_names, resolve_aliases


def dedup_full_row(df: DataFrame) -> DataFrame:
    """Drop exact copies; NULLs compare equal. Copies collapse in the map tasks before the shuffle."""
    return df.dropDuplicates()


def prepare_events(cleaned: DataFrame, grain: str = "minute") -> DataFrame:
    """Resolve column names, drop rows without a time, fill unknowns, add the time bucket.

    Spark keeps only the columns a mart reads, so nothing else leaves the scan.
    """
    df = resolve_aliases(normalize_names(cleaned, lower=False))
    timestamp = F.col("timestamp")
    if dict(df.dtypes)["timestamp"] == "string":
        timestamp = parse_utc(timestamp)
    return (
        drop_null(df.withColumn("timestamp", timestamp), ["timestamp"])
        .withColumns(
            {
                "event": fill_unknown(F.col("event")),
                "user_hash": fill_unknown(F.col("user_hash")),
                "bucket": time_bucket(F.col("timestamp"), grain),
            }
        )
    )


def _mart(counts: DataFrame, *columns) -> DataFrame:
    """Date and clock text follow from the bucket, so they are added after grouping and never shuffled."""
    bucket = F.col("bucket")
    return counts.select(
        bucket.alias("timestamp"), F.to_date(bucket).alias("date"), clock(bucket).alias("hora_completa"), *columns
    )


def count_events(prepared: DataFrame) -> DataFrame:
    """(bucket, user, service) counts: the only pass over the events that all three marts need."""
    return prepared.groupBy("bucket", "user_hash", classify_service(F.col("event")).alias("service")).agg(
        F.count("*").alias("requests")
    )


def _cost(by_service: DataFrame, unit_cost: float) -> DataFrame:
    return _mart(
        by_service, "service", "requests", F.bround(F.col("requests") * F.lit(unit_cost), 8).alias("cost")
    )


def _performance(by_user: DataFrame) -> DataFrame:
    # Counting users after a (bucket, user) step keeps a busy bucket out of a single distinct set.
    return _mart(
        by_user.groupBy("bucket").agg(F.sum("requests").alias("requests"), F.count("*").alias("unique_users")),
        "requests",
        "unique_users",
    )


def _security(by_user: DataFrame) -> DataFrame:
    scored = _mart(
        global_zscore(by_user, "requests", "requests_zscore"),
        "user_hash",
        "requests",
        "requests_zscore",
        off_hours_flag(F.hour("bucket")).alias("is_off_hours"),
    )
    return scored.withColumn("risk_level", risk_level(F.col("requests_zscore")))


def mart_cost(prepared: DataFrame, unit_cost: float = UNIT_COST) -> DataFrame:
    counts = prepared.groupBy("bucket", classify_service(F.col("event")).alias("service")).agg(
        F.count("*").alias("requests")
    )
    return _cost(counts, unit_cost)


def _count_by_user(prepared: DataFrame) -> DataFrame:
    return prepared.groupBy("bucket", "user_hash").agg(F.count("*").alias("requests"))


def mart_performance(prepared: DataFrame) -> DataFrame:
    return _performance(_count_by_user(prepared))


def mart_security(prepared: DataFrame) -> DataFrame:
    return _security(_count_by_user(prepared))


def marts_from_counts(counts: DataFrame, unit_cost: float = UNIT_COST) -> dict[str, DataFrame]:
    """All three marts from one table of `count_events`."""
    by_service = counts.groupBy("bucket", "service").agg(F.sum("requests").alias("requests"))
    by_user = counts.groupBy("bucket", "user_hash").agg(F.sum("requests").alias("requests"))
    return {"cost": _cost(by_service, unit_cost), "performance": _performance(by_user), "security": _security(by_user)}


def global_zscore(df: DataFrame, column: str, out: str = "zscore", digits: int | None = 4) -> DataFrame:
    """(x - mean) / sample deviation over the whole column, half-even rounded; 0 where the deviation is 0 or NULL.

    The two statistics are one row from a scalar subquery; rows are not shuffled for it.
    """
    stats = df.agg(
        F.struct(F.avg(column).alias("mean"), F.stddev_samp(column).alias("deviation")).alias("stats")
    ).scalar()
    deviation = stats["deviation"]
    score = F.when(deviation.isNull() | (deviation == 0), 0.0).otherwise((F.col(column) - stats["mean"]) / deviation)
    return df.withColumn(out, (F.bround(score, digits) if digits is not None else score) + F.lit(0.0))
