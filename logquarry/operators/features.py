"""Marts to the feature table: one row per minute."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.functions.columns import cyclic_calendar_features, guarded_ratio, parse_utc
from logquarry.functions.names import normalize_names

KEY = "timestamp"
MAX_DISCOVERED_SERVICES = 1000


def first_valid_timestamp(
    df: DataFrame, candidates=("timestamp", "eventTime"), fmt: str | None = None, out: str = KEY
) -> DataFrame:
    """Parse the first candidate column that holds at least one valid time (one aggregate decides).

    A single candidate that already has a time type is taken without looking at the data.
    """
    present = [c for c in candidates if c in df.columns]
    if len(present) == 1 and dict(df.dtypes)[present[0]] in ("timestamp", "timestamp_ntz", "date"):
        return df.withColumn(out, F.col(present[0]).cast("timestamp_ntz"))
    if present:
        valid = df.agg(*[F.count(parse_utc(F.col(c), fmt)).alias(c) for c in present]).first()
        for name in present:
            if valid[name]:
                return df.withColumn(out, parse_utc(F.col(name), fmt))
    raise ValueError(f"No valid time column among {list(candidates)}")


def left_equi_join(left: DataFrame, right: DataFrame, on: str = KEY) -> DataFrame:
    """Attach `right`, which holds one row per key, to every row of `left`."""
    return left.join(right, on, "left")


def full_outer_join_domains(parts: list[DataFrame], on: str = KEY) -> DataFrame:
    """Outer-join tables that each hold one row per key. All are partitioned by the key already."""
    return reduce(lambda a, b: a.join(b, on, "full_outer"), parts)


@dataclass
class Measures:
    """What one mart adds to a row of the feature table: sums (NULL counts as 0), means and maxima per minute."""

    mart: DataFrame
    sums: dict[str, Column] = field(default_factory=dict)
    means: dict[str, Column] = field(default_factory=dict)
    maxima: dict[str, Column] = field(default_factory=dict)


def _roll_up(parts: list[Measures]) -> DataFrame:
    """One row per minute of any part, holding every part's columns.

    The parts are stacked, each with its own columns, and grouped once: an outer join of per-part groupings
    without a join or a sort. Where a part has no row for a minute its columns stay NULL, as in the join.
    """
    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            part.mart.where(F.col(KEY).isNotNull()).select(
                KEY,
                *[F.coalesce(column, F.lit(0)).alias(name) for name, column in part.sums.items()],
                *[column.alias(name) for name, column in {**part.means, **part.maxima}.items()],
            )
            for part in parts
        ],
    )
    columns = []
    for part in parts:
        columns += [F.sum(f"`{name}`").alias(name) for name in part.sums]
        columns += [F.avg(f"`{name}`").alias(name) for name in part.means]
        columns += [F.max(f"`{name}`").alias(name) for name in part.maxima]
    return rows.groupBy(KEY).agg(*columns)


def cost_measures(cost: DataFrame, services: list[str] = ()) -> Measures:
    """Totals, and with `services` the requests and cost of each as own columns."""
    sums = {"total_cost": F.col("cost"), "total_requests_cost": F.col("requests")}
    if "unique_events" in cost.columns:
        sums["unique_events_cost"] = F.col("unique_events")
    return Measures(cost, {**sums, **_service_sums("requests", services), **_service_sums("cost", services)})


def performance_measures(performance: DataFrame) -> Measures:
    sums = {"total_requests_perf": F.col("requests"), "total_unique_users": F.col("unique_users")}
    if "unique_resources" in performance.columns:
        sums["total_unique_resources"] = F.col("unique_resources")
    means = {c: F.col(c) for c in ("requests_growth_pct", "rolling_requests_3") if c in performance.columns}
    return Measures(performance, sums, means)


def security_measures(security: DataFrame) -> Measures:
    sums = {"total_requests_security": F.col("requests")}
    if "rare_events_count" in security.columns:
        sums["rare_events_count"] = F.col("rare_events_count")
    means = {c: F.col(c) for c in ("rare_events_ratio_pct",) if c in security.columns}
    return Measures(security, sums, means)


def cost_totals(cost: DataFrame) -> DataFrame:
    return _roll_up([cost_measures(cost)])


def _service() -> Column:
    return F.lower(F.coalesce(F.col("service").cast("string"), F.lit("unknown")))


def discover_services(cost: DataFrame) -> list[str]:
    """Service names present in the mart; they become columns, so their number is checked."""
    found = cost.select(_service().alias("service")).distinct().limit(MAX_DISCOVERED_SERVICES + 1).collect()
    if len(found) > MAX_DISCOVERED_SERVICES:
        raise ValueError(f"More than {MAX_DISCOVERED_SERVICES} services: name the ones to pivot or use sums_per_service")
    return sorted(row[0] for row in found)


def _service_sums(value: str, services: list[str]) -> dict[str, Column]:
    return {f"{value}_service_{s}": F.when(_service() == s, F.col(value)) for s in services}


def _pivot(cost: DataFrame, value: str, services: list[str] | None) -> DataFrame:
    """One conditional sum per service in a single grouping; a service without rows in a minute counts 0."""
    services = discover_services(cost) if services is None else services
    return _roll_up([Measures(cost, _service_sums(value, services))])


def pivot_requests(cost: DataFrame, services: list[str] | None = None) -> DataFrame:
    """One column of summed requests per service.

    The services are read from the data first. Naming them saves that job and keeps the columns the same over
    runs; services that are not named get no column.
    """
    return _pivot(cost, "requests", services)


def pivot_cost(cost: DataFrame, services: list[str] | None = None) -> DataFrame:
    return _pivot(cost, "cost", services)


def sums_per_service(cost: DataFrame) -> DataFrame:
    """The numbers of both pivots as rows (timestamp, service, cost, requests), for any number of services."""
    rows = cost.where(F.col(KEY).isNotNull()).groupBy(KEY, _service().alias("service"))
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("cost", "requests")])


def performance_rollup(performance: DataFrame) -> DataFrame:
    return _roll_up([performance_measures(performance)])


def security_rollup(security: DataFrame) -> DataFrame:
    return _roll_up([security_measures(security)])


def mode_per_group(df: DataFrame, column: str, key: str = KEY, default: str = "unknown") -> DataFrame:
    """Most frequent value per key, the smallest on a tie, `default` where all are NULL.

    Values are counted per (key, value) first, so a task holds one running best per key, not a key's values.
    """
    counts = (
        df.where(F.col(key).isNotNull())
        .groupBy(key, F.col(column).cast("string").alias("_value"))
        .agg(F.count("*").alias("_n"))
    )
    best = F.min(F.when(F.col("_value").isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col("_value").alias("v"))))
    return counts.groupBy(key).agg(F.coalesce(best["v"], F.lit(default)).alias(column))


def with_ratio_features(df: DataFrame) -> DataFrame:
    """Derived ratios, each only where both of its columns exist."""
    ratios = [
        ("requests_vs_rolling_ratio", "total_requests_perf", "rolling_requests_3"),
        ("avg_cost_per_request", "total_cost", "total_requests_cost"),
        ("security_to_perf_ratio", "total_requests_security", "total_requests_perf"),
    ]
    return df.withColumns(
        {
            name: guarded_ratio(F.col(top), F.col(bottom))
            for name, top, bottom in ratios
            if top in df.columns and bottom in df.columns
        }
    )


def with_parsed_time(mart: DataFrame) -> DataFrame:
    return first_valid_timestamp(normalize_names(mart, lower=False))


def mart_measures(
    cost: DataFrame, performance: DataFrame, security: DataFrame, services: list[str] | None = None
) -> list[Measures]:
    """The measures of the three marts, in the column order of the feature table."""
    if "service" in cost.columns:
        services = discover_services(cost) if services is None else services
    else:
        services = []
    return [cost_measures(cost, services), performance_measures(performance), security_measures(security)]


def assemble_features(parts: list[Measures], security: DataFrame) -> DataFrame:
    """Roll the measures up and add dominant event, calendar and ratios."""
    joined = _roll_up(parts)
    if "dominant_event" in security.columns:
        joined = left_equi_join(joined, mode_per_group(security, "dominant_event"))
    return with_ratio_features(joined.withColumns(cyclic_calendar_features(F.col(KEY))))


def feature_store(
    cost: DataFrame, performance: DataFrame, security: DataFrame, services: list[str] | None = None
) -> DataFrame:
    """One row per minute seen in any mart: totals, pivots (see `pivot_requests`), calendar and ratios."""
    cost, performance, security = (with_parsed_time(mart) for mart in (cost, performance, security))
    return assemble_features(mart_measures(cost, performance, security, services), security)
