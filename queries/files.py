"""Readers and writers: each query writes to the shared folder and returns what is read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.operators import marts, metrics
from logquarry.session import shared_dir
from logquarry.sources import logs, sinks, snapshots
from queries.aggregates import COUNTS, REPORT, rounded_report, truth
from queries.inputs import RAW_LOGS, marts_sql, prepared, raw_logs, table
from queries.registry import query

DAY, LATER, MISSING = "2024-02-01", "2024-02-03", "2024-02-02"


@query("scan_log_csv", f"WITH {RAW_LOGS} SELECT * FROM raw_logs")
def _(spark, sf):
    path = shared_dir(spark, "queries/scan_log_csv")
    raw_logs(spark, sf).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return logs.scan_log_csv(spark, path)


@query("scan_parquet", "SELECT * FROM orders")
def _(spark, sf):
    return logs.scan_parquet(spark, f"{sf}/orders.parquet")


@query("scan_auto", f"WITH {marts_sql()} SELECT * FROM cost")
def _(spark, sf):
    path = shared_dir(spark, "queries/scan_auto/cost.csv")
    sinks.export_csv(marts.mart_cost(prepared(spark, sf)), path)
    return logs.scan_auto(spark, path, logs.MART_SCHEMAS["cost"])


def _dated_events(spark, sf):
    return table(spark, sf, "events").select(F.to_date("ts").alias("dt"), "event_id", "event_type")


@query(
    "latest_snapshot",
    """SELECT CAST(ts AS DATE) AS dt, event_id, event_type FROM events
       WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
)
def _(spark, sf):
    return snapshots.latest_snapshot(_dated_events(spark, sf))


@query(
    "expected_or_last_snapshot",
    "SELECT CAST(ts AS DATE) AS dt, event_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
)
def _(spark, sf):
    return snapshots.expected_or_last_snapshot(_dated_events(spark, sf), "2024-01-15")


@query("first_available_source", f"WITH {marts_sql()} SELECT * FROM performance")
def _(spark, sf):
    base = shared_dir(spark, "queries/first_available_source")
    mart = marts.mart_performance(prepared(spark, sf))
    mart.write.mode("overwrite").parquet(f"{base}/performance/dt={DAY}/performance.parquet")
    return snapshots.first_available_source(spark, "performance", "performance", [f"{base}-missing", base])


def _stored_marts(spark, sf, name: str) -> str:
    """The same mart as Parquet and CSV on one day, and with a column less on an earlier one."""
    base = shared_dir(spark, f"queries/{name}")
    mart = marts.mart_performance(prepared(spark, sf))
    mart.write.mode("overwrite").parquet(f"{base}/performance/dt={LATER}/performance.parquet")
    mart = spark.read.parquet(f"{base}/performance/dt={LATER}/performance.parquet")
    sinks.export_csv(mart.limit(1), f"{base}/performance/dt={LATER}/performance.csv")
    mart.drop("user_hash").write.mode("overwrite").parquet(f"{base}/performance/dt={DAY}/performance.parquet")
    return base


@query("latest_snapshot_path", f"WITH {marts_sql()} SELECT * FROM performance")
def _(spark, sf):
    """The later day wins over the earlier one, and Parquet over CSV within it; the other domain is looked for below all."""
    base = _stored_marts(spark, sf, "latest_snapshot_path")
    paths = {snapshots.latest_snapshot_path(spark, base, domain, "performance") for domain in ("performance", "elsewhere")}
    if len(paths) != 1:
        raise ValueError(f"Different snapshots: {paths}")
    return logs.scan_auto(spark, paths.pop())


@query("expected_or_last_path", f"WITH {RAW_LOGS} SELECT *, 'found' AS day FROM raw_logs UNION ALL SELECT *, 'last' FROM raw_logs")
def _(spark, sf):
    """A day that is there, and a missing one, for which the last listed day is read."""
    base = shared_dir(spark, "queries/expected_or_last_silver")
    for day in (DAY, LATER):
        raw_logs(spark, sf).withColumn("written", F.lit(day)).write.mode("overwrite").parquet(f"{base}/dt={day}/cleaned_logs.parquet")
    found = logs.scan_parquet(spark, snapshots.expected_or_last_path(spark, base, DAY)).where(F.col("written") == DAY)
    last = logs.scan_parquet(spark, snapshots.expected_or_last_path(spark, base, MISSING)).where(F.col("written") == LATER)
    return found.withColumn("day", F.lit("found")).unionByName(last.withColumn("day", F.lit("last"))).drop("written")


@query("write_bronze_raw", f"WITH {RAW_LOGS} SELECT * FROM raw_logs")
def _(spark, sf):
    path = shared_dir(spark, "queries/write_bronze_raw")
    sinks.write_bronze_raw(raw_logs(spark, sf), path, DAY)
    return spark.read.parquet(path).drop("dt")


@query("write_partitioned", f"WITH {marts_sql()} SELECT * FROM security")
def _(spark, sf):
    """The same day written twice: the second run replaces the first."""
    path = shared_dir(spark, "queries/write_partitioned")
    mart = marts.mart_security(prepared(spark, sf))
    sinks.write_partitioned(mart, path, DAY)
    sinks.write_partitioned(mart, path, DAY)
    return spark.read.parquet(path).drop("dt")


@query(
    "export_csv",
    f"""WITH {marts_sql()} SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", date, hora_completa, service,
        requests, printf('%.8f', cost) AS cost FROM cost""",
)
def _(spark, sf):
    return sinks.export_frame(marts.mart_cost(prepared(spark, sf)))


PREDICTED = """SELECT ts AS "timestamp", CASE WHEN value > 100 THEN 1 ELSE 0 END AS prediction, value AS score FROM events"""


@query("write_predictions", PREDICTED)
def _(spark, sf):
    path = shared_dir(spark, "queries/write_predictions")
    scored = table(spark, sf, "events").select(
        F.col("ts").alias("timestamp"), F.when(F.col("value") > 100, 1).otherwise(0).alias("prediction"),
        F.col("value").alias("score"),
    )
    sinks.write_predictions(scored, path)
    read = spark.read.schema("timestamp TIMESTAMP_NTZ, prediction INT, score DOUBLE").option("header", True)
    return read.csv(path)


LIMITS = (400, 800, 1600)
_RUNS = " UNION ALL ".join(
    f"""SELECT 'n_chars_{limit}' AS model, count(*) FILTER (quality = 0 AND n_chars <= {limit}) AS tn,
        count(*) FILTER (quality = 0 AND n_chars > {limit}) AS fp, count(*) FILTER (quality = 1 AND n_chars <= {limit}) AS fn,
        count(*) FILTER (quality = 1 AND n_chars > {limit}) AS tp FROM labels JOIN documents USING (doc_id)"""
    for limit in LIMITS
)


RANKED = f"""WITH cells AS ({_RUNS}) SELECT model, round((tp + tn) / (tn + fp + fn + tp), 10) AS accuracy,
  round(tp / (tp + fp), 10) AS precision, round(tp / (tp + fn), 10) AS recall, round(2 * tp / (2 * tp + fp + fn), 10) AS f1
FROM cells ORDER BY f1 DESC, model"""


def _runs(spark, sf):
    runs = reduce(
        DataFrame.unionByName,
        [metrics.binary_metrics(truth(spark, sf, n)).withColumn("model", F.lit(f"n_chars_{n}")) for n in LIMITS],
    )
    return runs.select("model", *[F.round(c, 10).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query("rank_models", RANKED)
def _(spark, sf):
    return sinks.rank_models(_runs(spark, sf))


@query("run_summary", RANKED)
def _(spark, sf):
    path, runs = shared_dir(spark, "queries/run_summary"), _runs(spark, sf)
    sinks.write_run_summary(runs, path)
    return sinks.rank_models(spark.read.schema(runs.schema).option("header", True).csv(path))


@query("report_json", f"WITH {COUNTS}, {REPORT}")
def _(spark, sf):
    path = shared_dir(spark, "queries/report_json")
    report = rounded_report(metrics.classification_report(truth(spark, sf)))
    sinks.write_json(report, path)
    return spark.read.schema(report.schema).json(path)
