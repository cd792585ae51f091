import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from logquarry.operators import features, labels, marts

T0 = dt.datetime(2024, 1, 1, 10, 0)


def minute(k):
    return T0 + dt.timedelta(minutes=k)


@pytest.mark.parametrize(
    "values, expected",
    [([5], [0.0]), ([3, 3, 3], [0.0, 0.0, 0.0]), ([], []), ([1, 2, 3], [-1.0, 0.0, 1.0])],
)
def test_zscore_edges(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    assert sorted(r[1] for r in rows(marts.global_zscore(df, "x"))) == expected


def test_zscore_rounds_half_to_even(spark):
    df = spark.createDataFrame([(2.50005,), (2.50015,)], "x double")
    assert [r[0] for r in rows(df.select(F.bround("x", 4)))] == [2.5, 2.5002]


def test_marts_agree_with_the_shared_counts(spark):
    events = spark.createDataFrame(
        [
            (minute(0), "RunInstances", "a"), (minute(0), "RunInstances", "a"), (minute(0), "ListUsers", "b"),
            (minute(0), None, None), (minute(1), "GetUser", None), (None, "GetUser", "a"),
        ],
        "timestamp timestamp_ntz, event string, user_hash string",
    )
    prepared = marts.prepare_events(events)
    shared = marts.marts_from_counts(marts.count_events(prepared))
    single = {
        "cost": marts.mart_cost(prepared), "performance": marts.mart_performance(prepared),
        "security": marts.mart_security(prepared),
    }
    for name, mart in single.items():
        assert sorted(rows(mart)) == sorted(rows(shared[name]))
    cost = {(r[0], r[3]): r[4:] for r in rows(single["cost"])}
    assert cost == {
        (minute(0), "ec2"): (2, 8e-06), (minute(0), "s3"): (1, 4e-06), (minute(0), "other_services"): (1, 4e-06),
        (minute(1), "iam"): (1, 4e-06),
    }
    assert {r[0]: r[3:] for r in rows(single["performance"])} == {minute(0): (4, 3), minute(1): (1, 1)}


def test_mode_ties_nulls_and_single_values(spark):
    data = [(0, "b"), (0, "a"), (1, None), (1, None), (2, "z"), (3, None), (3, None), (3, "q"), (None, "x")]
    df = spark.createDataFrame(
        [(None if k is None else minute(k), v) for k, v in data], "timestamp timestamp_ntz, dominant_event string"
    )
    found = dict(rows(features.mode_per_group(df, "dominant_event")))
    assert found == {minute(0): "a", minute(1): "unknown", minute(2): "z", minute(3): "q"}


def small_marts(spark):
    cost = spark.createDataFrame(
        [(minute(0), "S3", 2, 8e-06), (minute(0), None, 1, 4e-06), (minute(1), "ec2", None, None)],
        "timestamp timestamp_ntz, service string, requests bigint, cost double",
    )
    performance = spark.createDataFrame(
        [(minute(1), 4, 2, 8.0), (minute(2), 0, 0, None)],
        "timestamp timestamp_ntz, requests bigint, unique_users bigint, rolling_requests_3 double",
    )
    security = spark.createDataFrame(
        [(minute(2), "u", 3, "alto", "x"), (minute(3), "u", 1, "normal", None), (None, "u", 9, "alto", "y")],
        "timestamp timestamp_ntz, user_hash string, requests bigint, risk_level string, dominant_event string",
    )
    return cost, performance, security


def test_feature_store_is_the_outer_join_of_the_rollups(spark):
    cost, performance, security = small_marts(spark)
    store = features.feature_store(cost, performance, security, ["ec2", "s3", "unknown"])
    joined = features.full_outer_join_domains(
        [
            features.left_equi_join(
                features.left_equi_join(
                    features.cost_totals(cost), features.pivot_requests(cost, ["ec2", "s3", "unknown"])
                ),
                features.pivot_cost(cost, ["ec2", "s3", "unknown"]),
            ),
            features.performance_rollup(performance),
            features.left_equi_join(
                features.security_rollup(security), features.mode_per_group(security, "dominant_event")
            ),
        ]
    )
    assert sorted(rows(store.select(*joined.columns)), key=str) == sorted(rows(joined), key=str)
    by_minute = {r["timestamp"]: r for r in store.collect()}
    assert set(by_minute) == {minute(k) for k in range(4)}
    assert by_minute[minute(0)]["requests_service_unknown"] == 1
    assert by_minute[minute(0)]["total_requests_perf"] is None
    assert by_minute[minute(1)]["total_cost"] == 0 and by_minute[minute(1)]["avg_cost_per_request"] == 0.0
    assert by_minute[minute(1)]["requests_vs_rolling_ratio"] == 0.5
    assert by_minute[minute(2)]["security_to_perf_ratio"] == 0.0
    assert by_minute[minute(3)]["dominant_event"] == "unknown"


def test_services_can_be_discovered(spark):
    cost, performance, security = small_marts(spark)
    assert features.discover_services(cost) == ["ec2", "s3", "unknown"]
    assert "cost_service_unknown" in features.feature_store(cost, performance, security, None).columns
    without = features.feature_store(cost.drop("service"), performance, security)
    assert not [c for c in without.columns if "service" in c]


def test_weak_labels(spark):
    performance = spark.createDataFrame(
        [(minute(0), "PICO", None), (minute(1), "ok", " True "), (minute(2), None, "yes"), (None, "pico", "1")],
        "timestamp timestamp_ntz, performance_status string, is_peak string",
    )
    security = spark.createDataFrame(
        [(minute(2), "MÉDIO", "x", "0"), (minute(3), "normal", "5", None), (minute(4), None, "n/d", "TRUE"),
         (minute(5), "normal", "4.99", "0"), (minute(5), "normal", "NaN", None)],
        "timestamp timestamp_ntz, risk_level string, rare_events_ratio_pct string, is_unusual_access string",
    )
    found = {r[0]: r[1:] for r in rows(labels.weak_labels(performance, security))}
    assert found == {
        minute(0): (1, 0, 1), minute(1): (1, 0, 1), minute(2): (0, 1, 1), minute(3): (0, 1, 1), minute(4): (0, 1, 1),
        minute(5): (0, 0, 0),
    }


def test_present_marts_label_only_by_risk(spark):
    cost, performance, security = small_marts(spark)
    found = {r[0]: r[1:] for r in rows(labels.weak_labels(performance, security))}
    assert found == {minute(1): (0, 0, 0), minute(2): (0, 1, 1), minute(3): (0, 0, 0)}
    dataset = labels.modeling_dataset(cost, performance, security.withColumn("requests_zscore", F.lit(9.0)))
    assert {r["timestamp"]: r["is_anomaly"] for r in dataset.collect()} == {
        minute(0): 0, minute(1): 0, minute(2): 1, minute(3): 0,
    }
    assert not set(dataset.columns) & {"risk_level", "requests_zscore", "sec_anomaly"}
    joined = labels.attach_label(features.feature_store(cost, performance, security), labels.weak_labels(performance, security))
    assert sorted(rows(dataset.select(*joined.columns)), key=str) == sorted(rows(joined), key=str)


def test_hot_minute_and_hot_user(spark):
    """A third of all rows in one minute by one user: counts stay whole."""
    n = 30_000
    events = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(T0)).otherwise(
            F.timestamp_seconds(F.unix_timestamp(F.lit(T0)) + F.col("id")).cast("timestamp_ntz")
        ).alias("timestamp"),
        F.lit("GetObject").alias("event"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("user_hash"),
    )
    prepared = marts.prepare_events(events)
    top = marts.mart_security(prepared).orderBy(F.desc("requests")).first()
    assert (top["user_hash"], top["requests"], top["risk_level"]) == ("hot", n // 3, "alto")
    assert marts.mart_performance(prepared).agg(F.sum("requests")).first()[0] == n
