"""Names, cleaning, privacy, calendar and rule columns; deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from logquarry.functions import columns as c
from logquarry.functions import names as n
from logquarry.operators import features, labels, marts
from logquarry.plans import silver as s
from queries.inputs import MASKED_IP, RAW_LOGS, SERVICE, SILVER, WIDE
from queries.inputs import raw_logs, silver, table, wide_performance, wide_security
from queries.registry import query



@query("normalize_names", "SELECT event_id, ts AS eventtime, event_type AS eventname FROM events")
def _(spark, sf):
    events = table(spark, sf, "events")
    messy = events.select("event_id", F.col("ts").alias(" EventTime "), F.col("event_type").alias("EventName "))
    return n.normalize_names(messy)


@query(
    "resolve_aliases",
    """SELECT event_id, ts AS "timestamp", user_id AS user_hash, event_type AS event, isodow(ts)::INTEGER - 1 AS day_of_week
    FROM events""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    aliased = events.select(
        "event_id", F.col("ts").alias("Time"), F.col("user_id").alias("USER"), F.col("event_type").alias("eventName"),
        F.weekday("ts").alias("weekday"),
    )
    return n.resolve_aliases(aliased)


@query("drop_null_critical", f"WITH {RAW_LOGS} SELECT * FROM raw_logs WHERE eventtime IS NOT NULL AND eventname IS NOT NULL")
def _(spark, sf):
    return s.drop_null_critical(raw_logs(spark, sf))


@query(
    "parse_timestamp",
    f"""WITH {RAW_LOGS} SELECT TRY_CAST(eventtime AS TIMESTAMP) AS "timestamp", eventtime, requestparameters FROM raw_logs
    WHERE TRY_CAST(eventtime AS TIMESTAMP) IS NOT NULL""",
)
def _(spark, sf):
    parsed = raw_logs(spark, sf).select(
        c.parse_utc(F.col("eventtime")).alias("timestamp"), "eventtime", "requestparameters"
    )
    return parsed.where(F.col("timestamp").isNotNull())


@query("first_valid_timestamp", f'WITH {RAW_LOGS} SELECT errorcode, TRY_CAST(eventtime AS TIMESTAMP) AS "timestamp" FROM raw_logs')
def _(spark, sf):
    raw = raw_logs(spark, sf).select(F.col("errorcode"), F.col("errorcode").alias("timestamp"), F.col("eventtime").alias("eventTime"))
    return features.first_valid_timestamp(raw).select("errorcode", "timestamp")


@query("hash_user", f"WITH {RAW_LOGS} SELECT useridentityaccountid, sha256(useridentityaccountid) AS user_hash FROM raw_logs")
def _(spark, sf):
    return s.with_user_hash(raw_logs(spark, sf)).select("useridentityaccountid", "user_hash")


@query("mask_ip", f"WITH {RAW_LOGS} SELECT sourceipaddress, {MASKED_IP} AS masked_ip FROM raw_logs")
def _(spark, sf):
    return s.with_masked_ip(raw_logs(spark, sf)).select("sourceipaddress", "masked_ip")


@query("canonical_event_resource", f"WITH {RAW_LOGS} SELECT eventtime, eventname AS event, 'unknown' AS resource FROM raw_logs")
def _(spark, sf):
    return n.canonical_event_resource(raw_logs(spark, sf)).select("eventtime", "event", "resource")


@query("project_silver", f"WITH {SILVER} SELECT * FROM silver")
def _(spark, sf):
    return silver(spark, sf)


@query(
    "fill_unknown",
    f"""WITH {RAW_LOGS} SELECT coalesce(eventname, 'unknown') AS event, coalesce(useridentityaccountid, 'unknown') AS user_hash
    FROM raw_logs""",
)
def _(spark, sf):
    return raw_logs(spark, sf).select(
        c.fill_unknown(F.col("eventname")).alias("event"), c.fill_unknown(F.col("useridentityaccountid")).alias("user_hash")
    )


@query(
    "time_bucket",
    """SELECT event_id, date_trunc('minute', ts) AS bucket, CAST(date_trunc('minute', ts) AS DATE) AS date,
       strftime(date_trunc('minute', ts), '%H:%M') AS hora_completa, hour(ts)::INTEGER AS hour FROM events""",
)
def _(spark, sf):
    bucket = F.col("bucket")
    return (
        table(spark, sf, "events")
        .select("event_id", c.time_bucket(F.col("ts")).alias("bucket"))
        .withColumns({"date": F.to_date(bucket), "hora_completa": c.clock(bucket), "hour": F.hour(bucket)})
    )


@query(
    "calendar_parts",
    """SELECT event_id, hour(ts)::INTEGER AS hour, minute(ts)::INTEGER AS minute, strftime(ts, '%H:%M') AS hora_completa,
       isodow(ts)::INTEGER - 1 AS day_of_week, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM events""",
)
def _(spark, sf):
    return table(spark, sf, "events").withColumns(c.calendar_parts(F.col("ts"))).select(
        "event_id", "hour", "minute", "hora_completa", "day_of_week", "is_weekend"
    )


@query(
    "cyclic_calendar_features",
    """SELECT event_id, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day,
       hour(ts)::INTEGER AS hour, isodow(ts)::INTEGER - 1 AS day_of_week,
       CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       round(sin(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_cos
       FROM events""",
)
def _(spark, sf):
    parts = c.cyclic_calendar_features(F.col("ts"))
    rounded = {k: F.round(v, 6) + F.lit(0.0) if k.startswith("hour_") else v for k, v in parts.items()}
    return table(spark, sf, "events").withColumns(rounded).select("event_id", *rounded)


@query("classify_service", f"WITH {RAW_LOGS} SELECT event, {SERVICE} AS service FROM (SELECT coalesce(eventname, '') AS event FROM raw_logs)")
def _(spark, sf):
    return raw_logs(spark, sf).select(
        F.coalesce("eventname", F.lit("")).alias("event"), c.classify_service(F.col("eventname")).alias("service")
    )


@query("off_hours_flag", "SELECT event_id, hour(ts) IN (0, 1, 2, 3, 4, 5, 23) AS is_off_hours FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", c.off_hours_flag(F.hour("ts")).alias("is_off_hours"))


@query("risk_level", "SELECT event_id, CASE WHEN value / 100 > 2.5 THEN 'alto' ELSE 'normal' END AS risk_level FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", c.risk_level(F.col("value") / 100).alias("risk_level"))


@query(
    "normalize_boolean",
    f"""WITH {WIDE} SELECT "timestamp", is_peak, CASE WHEN lower(trim(is_peak)) IN ('true', '1') THEN 1 ELSE 0 END AS flag
    FROM performance""",
)
def _(spark, sf):
    return wide_performance(spark, sf).select("timestamp", "is_peak", c.normalize_boolean(F.col("is_peak")).alias("flag"))


@query(
    "safe_divide",
    """SELECT event_id, CASE WHEN user_id % 5 = 0 THEN 0.0 ELSE round(value / (user_id % 5), 6) END AS ratio FROM events""",
)
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.round(c.safe_divide(F.col("value"), F.col("user_id") % 5), 6).alias("ratio")
    )


@query(
    "guarded_ratio_features",
    f"""WITH {WIDE} SELECT "timestamp", requests AS total_requests_perf, rolling_requests_3,
       unique_users AS total_requests_security,
       CASE WHEN rolling_requests_3 > 0 THEN round(requests / rolling_requests_3, 6) ELSE 0.0 END AS requests_vs_rolling_ratio,
       CASE WHEN requests > 0 THEN round(CAST(unique_users AS DOUBLE) / requests, 6) ELSE 0.0 END AS security_to_perf_ratio
    FROM performance""",
)
def _(spark, sf):
    wide = wide_performance(spark, sf).select(
        "timestamp", F.col("requests").alias("total_requests_perf"), "rolling_requests_3",
        F.col("unique_users").alias("total_requests_security"),
    )
    ratios = features.with_ratio_features(wide)
    names = ["requests_vs_rolling_ratio", "security_to_perf_ratio"]
    return ratios.withColumns({name: F.round(name, 6) for name in names})


@query(
    "weak_label_rules",
    f"""WITH {WIDE} SELECT 'performance' AS mart, "timestamp", requests,
       CASE WHEN lower(performance_status) IN ('crescimento_abrupto', 'degradado', 'pico', 'anômalo', 'anomalo')
              OR lower(trim(coalesce(is_peak, ''))) IN ('true', '1') THEN 1 ELSE 0 END AS anomaly FROM performance
    UNION ALL SELECT 'security', "timestamp", requests,
       CASE WHEN lower(risk_level) IN ('medio', 'médio', 'alto', 'critico', 'crítico')
              OR lower(trim(is_unusual_access)) IN ('true', '1')
              OR coalesce(TRY_CAST(rare_events_ratio_pct AS DOUBLE), 0) >= 5 THEN 1 ELSE 0 END FROM security""",
)
def _(spark, sf):
    performance, security = wide_performance(spark, sf), wide_security(spark, sf)
    return performance.select(
        F.lit("performance").alias("mart"), "timestamp", "requests", labels.performance_alert(performance).alias("anomaly")
    ).unionByName(
        security.select(
            F.lit("security").alias("mart"), "timestamp", "requests", labels.security_alert(security).alias("anomaly")
        )
    )


@query("drop_leakage_columns", f"""WITH {WIDE} SELECT "timestamp", user_hash, requests, rare_events_count, rare_events_ratio_pct,
    dominant_event FROM security""")
def _(spark, sf):
    return n.drop_leakage_columns(wide_security(spark, sf))


@query("drop_all_null_signal", f"""WITH {RAW_LOGS} SELECT eventtime AS "timestamp", eventname, useridentityaccountid FROM raw_logs
    WHERE eventname IS NOT NULL OR useridentityaccountid IS NOT NULL""")
def _(spark, sf):
    raw = raw_logs(spark, sf).select(F.col("eventtime").alias("timestamp"), "eventname", "useridentityaccountid")
    return n.drop_all_null_signal(raw)


@query(
    "split_columns_by_dtype",
    """SELECT count(*) AS n_rows, 'event_id,user_id,value' AS numeric_columns, 'ts,event_type,props' AS other_columns FROM events""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    numeric, other = n.split_columns_by_dtype(events)
    return events.agg(F.count("*").alias("n_rows")).withColumns(
        {"numeric_columns": F.lit(",".join(numeric)), "other_columns": F.lit(",".join(other))}
    )


@query("dedup_full_row", f"WITH {RAW_LOGS} SELECT DISTINCT * FROM raw_logs")
def _(spark, sf):
    return marts.dedup_full_row(raw_logs(spark, sf))


