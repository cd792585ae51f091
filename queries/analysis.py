"""Totals at several grains, merged distinct counts, as-of joins, JSON fields, incremental corpus, records with line breaks."""

from __future__ import annotations

from pyspark.sql import functions as F

from logquarry.functions import json_fields
from logquarry.operators import asof, marts as m, profile, rollups
from logquarry.plans import corpus as corpus_plan
from logquarry.session import shared_dir
from logquarry.sources import logs, sinks
from queries.inputs import RAW_LOGS, SERVICE, marts, marts_sql, prepared, prepared_sql, raw_logs, table
from queries.registry import query
from queries.retrieval import letter_counts

# --- totals and distinct counts ----------------------------------------------------------------------------------

COUNTED = f"""{prepared_sql('minute')},
counted AS (SELECT CAST(bucket AS DATE) AS day, {SERVICE} AS service, user_hash, count(*) AS requests FROM prepared GROUP BY ALL)"""


@query(
    "usage_rollup",
    f"""WITH {COUNTED} SELECT day, service, user_hash, CASE grouping_id(day, service, user_hash) WHEN 1 THEN 'day+service'
        WHEN 2 THEN 'day+user_hash' WHEN 3 THEN 'day' WHEN 5 THEN 'service' WHEN 6 THEN 'user_hash' ELSE 'all' END AS level,
        CAST(sum(requests) AS BIGINT) AS requests, count(*) AS cells
    FROM counted GROUP BY GROUPING SETS ((day, service), (day, user_hash), (day), (service), (user_hash), ())""",
)
def _(spark, sf):
    return rollups.usage_rollup(m.count_events(prepared(spark, sf)))


@query(
    "merged_users",
    f"""WITH {COUNTED} SELECT day, CAST(sum(requests) AS BIGINT) AS requests, count(DISTINCT user_hash) AS unique_users,
        true AS within_bound FROM counted GROUP BY day""",
)
def _(spark, sf):
    """Sketches per minute and service stored, merged to days: within four standard errors of the exact counts."""
    counts = m.count_events(prepared(spark, sf))
    path = shared_dir(spark, "queries/merged_users")
    rollups.user_sketches(counts).write.mode("overwrite").parquet(path)
    day = F.to_date("bucket").alias("day")
    estimated = rollups.merged_users(spark.read.parquet(path), day)
    exact = counts.select(day, "user_hash").distinct().groupBy("day").agg(F.count(F.lit(1)).alias("exact"))
    bound = 4 * 1.04 / 2 ** (rollups.LOG_REGISTERS / 2)
    near = F.abs(F.col("unique_users") - F.col("exact")) <= bound * F.col("exact") + 0.5
    return estimated.join(exact, "day").select("day", "requests", F.col("exact").alias("unique_users"), near.alias("within_bound"))


# --- as-of joins -----------------------------------------------------------------------------------------------------


@query(
    "as_of_join",
    f"""WITH {marts_sql()} SELECT e.event_id, p."timestamp" AS mart_time, p.requests, p.unique_users
    FROM events e ASOF LEFT JOIN performance p ON e.ts >= p."timestamp" """,
)
def _(spark, sf):
    """Every event with the latest minute of the performance mart that is not later."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("timestamp"))
    found = asof.as_of_join(events, marts(spark, sf)["performance"], [], "timestamp", "mart")
    return found.select("event_id", F.col("mart.timestamp").alias("mart_time"), "mart.requests", "mart.unique_users")


@query(
    "as_of_join_by_user",
    """WITH first AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts)
    SELECT e.event_id, p.ts AS purchased, p.value FROM events e ASOF LEFT JOIN first p ON e.user_id = p.user_id AND e.ts > p.ts""",
)
def _(spark, sf):
    """Every event with its user's last purchase before it."""
    events = table(spark, sf, "events")
    bought = events.where("event_type = 'purchase'").select("user_id", "ts", "value")
    found = asof.as_of_join(events.select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", strict=True)
    return found.select("event_id", F.col("matched.ts").alias("purchased"), "matched.value")


# --- JSON columns ------------------------------------------------------------------------------------------------------

# Request parameters as logs have them: nested, of mixed types, some missing or cut off.
_JSON = """CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 19 = 0 THEN substr(props, 1, length(props) - 1)
  WHEN event_id % 7 = 0 THEN '{"k": "'||event_type||'", "more": {"user": '||user_id||', "tags": ["a", "b"], "note": null}}'
  WHEN event_id % 5 = 0 THEN '{"more": {"user": "'||user_id||'", "ok": true}, "list": []}' ELSE props END"""
REQUESTS = f"requests AS (SELECT event_id, {_JSON} AS parameters FROM events)"


def _requests(spark, sf):
    return table(spark, sf, "events").selectExpr("event_id", f"{_JSON} AS parameters")


@query(
    "json_quality",
    f"""WITH {REQUESTS} SELECT count(*) AS n_rows, count(*) FILTER (parameters IS NULL) AS n_null,
        count(*) FILTER (NOT json_valid(parameters)) AS n_bad FROM requests""",
)
def _(spark, sf):
    return json_fields.json_quality(_requests(spark, sf), "parameters")


_KIND = """CASE json_type(v) WHEN 'UBIGINT' THEN 'bigint' WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
  WHEN 'NULL' THEN 'void' WHEN 'DOUBLE' THEN 'number' ELSE lower(json_type(v)) END"""


@query(
    "json_fields",
    f"""WITH {REQUESTS}, valid AS (SELECT CAST(parameters AS JSON) AS j FROM requests WHERE json_valid(parameters)),
    top AS (SELECT '$.'||key AS path, json_extract(j, '$."'||key||'"') AS v FROM (SELECT j, unnest(json_keys(j)) AS key FROM valid)),
    inner_fields AS (SELECT path||'.'||key AS path, json_extract(v, '$."'||key||'"') AS v
      FROM (SELECT path, v, unnest(json_keys(v)) AS key FROM top WHERE json_type(v) = 'OBJECT'))
    SELECT path, {_KIND} AS type, count(*) AS n_rows FROM (SELECT * FROM top UNION ALL SELECT * FROM inner_fields) GROUP BY ALL""",
)
def _(spark, sf):
    return json_fields.discover_fields(_requests(spark, sf), "parameters")


@query(
    "json_shred",
    f"""WITH {REQUESTS}, valid AS (SELECT event_id, parameters, CASE WHEN json_valid(parameters) THEN CAST(parameters AS JSON) END AS j FROM requests)
    SELECT event_id, parameters, TRY_CAST(json_extract_string(j, '$.k') AS BIGINT) AS k, json_extract_string(j, '$.k') AS k_text,
      TRY_CAST(json_extract_string(j, '$.more.user') AS BIGINT) AS more_user, CAST(json_extract(j, '$.more.ok') AS BOOLEAN) AS ok,
      json_extract_string(j, '$.more.tags[1]') AS second_tag, parameters IS NOT NULL AND NOT json_valid(parameters) AS is_bad FROM valid""",
)
def _(spark, sf):
    fields = {
        "k": ("$.k", "bigint"), "k_text": ("$.k", "string"), "more_user": ("$.more.user", "bigint"),
        "ok": ("$.more.ok", "boolean"), "second_tag": ("$.more.tags[1]", "string"),
    }
    return json_fields.shred_fields(_requests(spark, sf), "parameters", fields, "is_bad")


# --- corpus and files --------------------------------------------------------------------------------------------------


@query(
    "update_corpus",
    """SELECT lang AS domain, text, CAST(length(text) AS DOUBLE) AS length FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL
    UNION ALL SELECT lang, text, CAST(length(text) AS DOUBLE) FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL AND doc_id % 9 = 0""",
)
def _(spark, sf):
    """An older corpus, with a domain that is gone, other wordings, missing and spare rows, brought to the documents."""
    path = shared_dir(spark, "queries/update_corpus")
    docs = table(spark, sf, "documents").where("text IS NOT NULL AND lang IS NOT NULL")

    def texts(df, lang=F.col("lang"), text=F.col("text")):
        return df.select(F.xxhash64("doc_id", lang, text).alias("id"), lang.alias("domain"), text.alias("text"))

    ninth = F.col("doc_id") % 9 == 0
    older = texts(docs.where("doc_id % 5 <> 0"), text=F.when(F.col("doc_id") % 7 == 0, F.upper("text")).otherwise(F.col("text")))
    older = older.unionByName(texts(docs.where("doc_id % 4 = 0"))).unionByName(texts(docs.where(ninth), F.lit("gone")))
    corpus_plan.write_corpus(corpus_plan.embed_texts(older, "text", letter_counts, 4), path)
    corpus_plan.update_corpus(spark, texts(docs).unionByName(texts(docs.where(ninth))), path, letter_counts, 4)
    return spark.read.parquet(path).select("domain", "text", F.col("embedding")[0].cast("double").alias("length"))


@query("counted_write", f"WITH {marts_sql()} SELECT 'security' AS dataset, count(*) AS n_rows, count(*) AS stored FROM security")
def _(spark, sf):
    """Rows counted from the footers of what was written, next to those read back."""
    path = shared_dir(spark, "queries/counted_write")
    n_rows = sinks.write_counted(marts(spark, sf)["security"], sinks.write_partitioned, path, "2024-02-01")
    stored = spark.read.parquet(path).drop("dt")
    found = profile.profile_columns({"security": stored}, {"security": n_rows}).select("dataset", "n_rows").distinct()
    return found.withColumn("stored", stored.agg(F.count(F.lit(1))).scalar())


@query(
    "scan_log_csv_records",
    f"""WITH {RAW_LOGS} SELECT eventtime, eventname, requestparameters||chr(10)||'"at", '||eventtime||chr(10) AS requestparameters FROM raw_logs""",
)
def _(spark, sf):
    """Cells with quotes, separators and line breaks, read from files that stay split."""
    path = shared_dir(spark, "queries/scan_log_csv_records")
    cell = F.concat("requestparameters", F.lit('\n"at", '), "eventtime", F.lit("\n")).alias("requestparameters")
    written = raw_logs(spark, sf).select("eventtime", "eventname", cell)
    writer = written.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return logs.scan_log_csv(spark, path)
