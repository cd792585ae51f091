"""Rule-based labels and the modelling table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.fixed_values import (
    LEAKAGE_COLUMNS, PERFORMANCE_ALERT_WORDS, RARE_EVENTS_THRESHOLD, RISK_ALERT_WORDS,
)
from logquarry.functions.columns import normalize_boolean
from logquarry.functions.names import drop_all_null_signal, drop_leakage_columns
from logquarry.operators.features import KEY, assemble_features, left_equi_join, mart_measures, with_parsed_time


def _either(flags: list[Column]) -> Column:
    return F.greatest(F.lit(0), F.lit(0), *flags)


def _word_flag(column: str, words) -> Column:
    return F.when(F.lower(F.col(column).cast("string")).isin(words), 1).otherwise(0)


def performance_alert(performance: DataFrame, words=PERFORMANCE_ALERT_WORDS) -> Column:
    flags = []
    if "performance_status" in performance.columns:
        flags.append(_word_flag("performance_status", words))
    if "is_peak" in performance.columns:
        flags.append(normalize_boolean(F.col("is_peak")))
    return _either(flags)


def security_alert(
    security: DataFrame, words=RISK_ALERT_WORDS, rare_threshold: float = RARE_EVENTS_THRESHOLD
) -> Column:
    flags = []
    if "risk_level" in security.columns:
        flags.append(_word_flag("risk_level", words))
    if "is_unusual_access" in security.columns:
        flags.append(normalize_boolean(F.col("is_unusual_access")))
    if "rare_events_ratio_pct" in security.columns:
        ratio = F.col("rare_events_ratio_pct").try_cast("double")
        flags.append(F.when(F.coalesce(F.nanvl(ratio, F.lit(0.0)), F.lit(0.0)) >= rare_threshold, 1).otherwise(0))
    return _either(flags)


def flag_max(df: DataFrame, flag: str, key: str = KEY) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(flag).alias(flag))


def distinct_union_keys(a: DataFrame, b: DataFrame, key: str = KEY) -> DataFrame:
    return a.select(key).union(b.select(key)).where(F.col(key).isNotNull()).distinct()


def weak_labels(performance: DataFrame, security: DataFrame) -> DataFrame:
    """(timestamp, perf_anomaly, sec_anomaly, is_anomaly) for every minute of either mart.

    Keys and flags come from one grouping of the two marts' flag rows: the union of keys, the per-key maxima
    and the join of both are the same shuffle.
    """
    performance, security = with_parsed_time(performance), with_parsed_time(security)
    none = F.lit(0)
    flags = performance.select(
        KEY, performance_alert(performance).alias("perf_anomaly"), none.alias("sec_anomaly")
    ).unionByName(security.select(KEY, none.alias("perf_anomaly"), security_alert(security).alias("sec_anomaly")))
    labels = (
        flags.where(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.max("perf_anomaly").alias("perf_anomaly"), F.max("sec_anomaly").alias("sec_anomaly"))
    )
    return labels.withColumn("is_anomaly", F.greatest("perf_anomaly", "sec_anomaly"))


def attach_label(features: DataFrame, labels: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """Left-join the label; a minute without one counts as 0."""
    joined = left_equi_join(features, labels.select(KEY, label))
    return joined.withColumn(label, F.coalesce(F.col(label), F.lit(0)).cast("int"))


def modeling_dataset(
    cost: DataFrame, performance: DataFrame, security: DataFrame, services: list[str] | None = None,
    leakage=LEAKAGE_COLUMNS,
) -> DataFrame:
    """Features with label, without leaking columns and rows that carry no signal.

    The flags are maxima of the same per-minute grouping that makes the features: every labelled minute is a
    feature row, so joining `weak_labels` to `feature_store` gives the same table at the cost of a join.
    """
    cost, performance, security = (with_parsed_time(mart) for mart in (cost, performance, security))
    of_cost, of_performance, of_security = mart_measures(cost, performance, security, services)
    of_performance.maxima["perf_anomaly"] = performance_alert(performance)
    of_security.maxima["sec_anomaly"] = security_alert(security)
    rows = assemble_features([of_cost, of_performance, of_security], security)
    label = F.coalesce(F.greatest("perf_anomaly", "sec_anomaly"), F.lit(0)).cast("int")
    labelled = rows.withColumn("is_anomaly", label).drop("perf_anomaly", "sec_anomaly")
    return drop_all_null_signal(drop_leakage_columns(labelled, leakage))
