"""Marts, statistics, features, labels, splits and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from logquarry.fixed_values import (
    COLUMN_DESCRIPTIONS, DATASET_PURPOSES, DATASET_QUESTIONS, DEFAULT_DESCRIPTIONS, NO_QUESTIONS, SERVICES,
)
from logquarry.operators import features, labels, marts, metrics, profile, ranking, rolling
from queries.inputs import WIDE, marts_sql, prepared, raw_logs, silver, table, wide_performance, wide_security
from queries.inputs import marts as all_marts
from queries.registry import query


@query("mart_cost", f"WITH {marts_sql()} SELECT * FROM cost")
def _(spark, sf):
    return marts.mart_cost(prepared(spark, sf))


@query("mart_performance", f"WITH {marts_sql()} SELECT * FROM performance")
def _(spark, sf):
    return marts.mart_performance(prepared(spark, sf))


@query(
    "rolling_features",
    f"""WITH {marts_sql()}
    SELECT *, round(avg(CAST(requests AS DOUBLE)) OVER (ORDER BY "timestamp" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 8) AS rolling_requests_3,
      round(coalesce(100.0::DOUBLE * (requests - lag(requests) OVER (ORDER BY "timestamp")) / lag(requests) OVER (ORDER BY "timestamp"), 0), 8)
        AS requests_growth_pct
    FROM performance""",
)
def _(spark, sf):
    """The optional columns of the performance mart: mean of three minutes and change against the minute before."""
    found = rolling.request_trend(all_marts(spark, sf)["performance"])
    return found.withColumns({c: F.round(c, 8) for c in ("rolling_requests_3", "requests_growth_pct")})


@query(
    "rolling_event_values",
    """SELECT event_id, round(sum(value) OVER latest, 6) AS last_ten, count(value) OVER latest AS n, lag(event_id, 7) OVER (ORDER BY user_id NULLS FIRST, event_id) AS seventh
    FROM events WINDOW latest AS (ORDER BY user_id NULLS FIRST, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
)
def _(spark, sf):
    """Windows over the order of all events, in which many rows share the leading key."""

    def columns(window):
        latest = window.rowsBetween(-9, 0)
        return {"last_ten": F.round(F.sum("value").over(latest), 6), "n": F.count("value").over(latest), "seventh": F.lag("event_id", 7).over(window)}

    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    return rolling.over_ranges(events, ["user_id", "event_id"], 9, columns).select("event_id", "last_ten", "n", "seventh")


@query("mart_security", f"WITH {marts_sql()} SELECT * FROM security")
def _(spark, sf):
    return marts.mart_security(prepared(spark, sf))


@query("mart_security_hourly", f"WITH {marts_sql('hour')} SELECT * FROM security")
def _(spark, sf):
    return marts.mart_security(prepared(spark, sf, "hour"))


@query(
    "global_zscore",
    """SELECT event_id, round_even((value - (SELECT avg(value) FROM events)) / (SELECT stddev_samp(value) FROM events), 4)
       + 0.0 AS zscore FROM events""",
)
def _(spark, sf):
    return marts.global_zscore(table(spark, sf, "events"), "value").select("event_id", "zscore")


@query(
    "sums_per_service",
    f"""WITH {marts_sql()} SELECT "timestamp", service, round(sum(cost), 8) AS cost, CAST(sum(requests) AS BIGINT) AS requests
        FROM cost GROUP BY ALL""",
)
def _(spark, sf):
    return features.sums_per_service(marts.mart_cost(prepared(spark, sf))).withColumn("cost", F.round("cost", 8))


@query(
    "cost_totals",
    f"""WITH {marts_sql()} SELECT "timestamp", round(sum(cost), 8) AS total_cost,
        CAST(sum(requests) AS BIGINT) AS total_requests_cost FROM cost GROUP BY ALL""",
)
def _(spark, sf):
    totals = features.cost_totals(marts.mart_cost(prepared(spark, sf)))
    return totals.withColumn("total_cost", F.round("total_cost", 8))


def _pivot_sql(value: str, cast: str) -> str:
    cells = ", ".join(
        f"{cast.format(x=f'''coalesce(sum(CASE WHEN service = '{s}' THEN {value} END), 0)''')} AS {value}_service_{s}"
        for s in ("ec2", "iam", "other_services", "s3")
    )
    return f'WITH {marts_sql()} SELECT "timestamp", {cells} FROM cost GROUP BY "timestamp"'


@query("pivot_requests", _pivot_sql("requests", "CAST({x} AS BIGINT)"))
def _(spark, sf):
    return features.pivot_requests(marts.mart_cost(prepared(spark, sf)), SERVICES)


@query("pivot_cost", _pivot_sql("cost", "round({x}, 8)"))
def _(spark, sf):
    pivoted = features.pivot_cost(marts.mart_cost(prepared(spark, sf)), SERVICES)
    return pivoted.withColumns({c: F.round(c, 8) for c in pivoted.columns if c != "timestamp"})


@query(
    "performance_rollup",
    f"""WITH {WIDE} SELECT "timestamp", CAST(sum(requests) AS BIGINT) AS total_requests_perf,
        CAST(sum(unique_users) AS BIGINT) AS total_unique_users, CAST(sum(unique_resources) AS BIGINT) AS total_unique_resources,
        round(avg(requests_growth_pct), 6) AS requests_growth_pct, round(avg(rolling_requests_3), 6) AS rolling_requests_3
    FROM performance GROUP BY "timestamp" """,
)
def _(spark, sf):
    rollup = features.performance_rollup(wide_performance(spark, sf))
    return rollup.withColumns({c: F.round(c, 6) for c in ("requests_growth_pct", "rolling_requests_3")})


def _numeric_security(spark, sf):
    return wide_security(spark, sf).withColumn(
        "rare_events_ratio_pct", F.col("rare_events_ratio_pct").try_cast("double")
    )


@query(
    "security_rollup",
    f"""WITH {WIDE} SELECT "timestamp", CAST(sum(requests) AS BIGINT) AS total_requests_security,
        CAST(sum(rare_events_count) AS BIGINT) AS rare_events_count,
        round(avg(TRY_CAST(rare_events_ratio_pct AS DOUBLE)), 6) AS rare_events_ratio_pct
    FROM security GROUP BY "timestamp" """,
)
def _(spark, sf):
    rollup = features.security_rollup(_numeric_security(spark, sf))
    return rollup.withColumn("rare_events_ratio_pct", F.round("rare_events_ratio_pct", 6))


MODES = """modes AS (
  SELECT "timestamp", coalesce(min(CASE WHEN place = 1 THEN dominant_event END), 'unknown') AS dominant_event FROM (
    SELECT "timestamp", dominant_event, row_number() OVER (
      PARTITION BY "timestamp" ORDER BY dominant_event IS NULL, count(*) DESC, dominant_event) AS place
    FROM security GROUP BY "timestamp", dominant_event) AS counted GROUP BY "timestamp")"""


@query("mode_per_group", f"WITH {WIDE}, {MODES} SELECT * FROM modes")
def _(spark, sf):
    return features.mode_per_group(wide_security(spark, sf), "dominant_event")


FLAGS = """perf_flags AS (
  SELECT "timestamp", max(CASE WHEN lower(performance_status) IN ('crescimento_abrupto', 'degradado', 'pico', 'anômalo', 'anomalo')
    OR lower(trim(coalesce(is_peak, ''))) IN ('true', '1') THEN 1 ELSE 0 END) AS perf_anomaly
  FROM performance GROUP BY "timestamp"),
sec_flags AS (
  SELECT "timestamp", max(CASE WHEN lower(risk_level) IN ('medio', 'médio', 'alto', 'critico', 'crítico')
    OR lower(trim(is_unusual_access)) IN ('true', '1')
    OR coalesce(TRY_CAST(rare_events_ratio_pct AS DOUBLE), 0) >= 5 THEN 1 ELSE 0 END) AS sec_anomaly
  FROM security GROUP BY "timestamp")"""


@query("flag_max", f"WITH {WIDE}, {FLAGS} SELECT * FROM sec_flags")
def _(spark, sf):
    security = wide_security(spark, sf)
    return labels.flag_max(security.withColumn("sec_anomaly", labels.security_alert(security)), "sec_anomaly")


LABELS = f"""{FLAGS},
labels_found AS (
  SELECT "timestamp", coalesce(perf_anomaly, 0) AS perf_anomaly, coalesce(sec_anomaly, 0) AS sec_anomaly,
         greatest(coalesce(perf_anomaly, 0), coalesce(sec_anomaly, 0)) AS is_anomaly
  FROM perf_flags FULL OUTER JOIN sec_flags USING ("timestamp"))"""


@query("weak_labels", f"WITH {WIDE}, {LABELS} SELECT * FROM labels_found")
def _(spark, sf):
    return labels.weak_labels(wide_performance(spark, sf), wide_security(spark, sf))


def features_sql(grain: str) -> str:
    """Feature table of the marts as SQL text (columns rounded where sums of doubles meet)."""
    pivots = ", ".join(
        f"CAST(coalesce(sum(CASE WHEN service = '{s}' THEN requests END), 0) AS BIGINT) AS requests_service_{s}, "
        f"round(coalesce(sum(CASE WHEN service = '{s}' THEN cost END), 0), 8) AS cost_service_{s}"
        for s in ("ec2", "iam", "other_services", "s3")
    )
    return f"""{marts_sql(grain)},
c AS (SELECT "timestamp", round(sum(cost), 8) AS total_cost, CAST(sum(requests) AS BIGINT) AS total_requests_cost, {pivots}
  FROM cost GROUP BY "timestamp"),
p AS (SELECT "timestamp", CAST(sum(requests) AS BIGINT) AS total_requests_perf,
  CAST(sum(unique_users) AS BIGINT) AS total_unique_users FROM performance GROUP BY "timestamp"),
s AS (SELECT "timestamp", CAST(sum(requests) AS BIGINT) AS total_requests_security FROM security GROUP BY "timestamp"),
joined AS (SELECT * FROM c FULL OUTER JOIN p USING ("timestamp") FULL OUTER JOIN s USING ("timestamp")),
features AS (
  SELECT *, year("timestamp")::INTEGER AS year, month("timestamp")::INTEGER AS month, day("timestamp")::INTEGER AS day,
    hour("timestamp")::INTEGER AS hour, isodow("timestamp")::INTEGER - 1 AS day_of_week,
    CASE WHEN isodow("timestamp") >= 6 THEN 1 ELSE 0 END AS is_weekend,
    round(sin(2 * pi() * hour("timestamp") / 24), 6) + 0.0 AS hour_sin,
    round(cos(2 * pi() * hour("timestamp") / 24), 6) + 0.0 AS hour_cos,
    CASE WHEN coalesce(total_requests_cost, 0) > 0 THEN round(coalesce(total_cost, 0) / total_requests_cost, 8) ELSE 0.0 END
      AS avg_cost_per_request,
    CASE WHEN coalesce(total_requests_perf, 0) > 0
      THEN round(CAST(coalesce(total_requests_security, 0) AS DOUBLE) / total_requests_perf, 8) ELSE 0.0 END
      AS security_to_perf_ratio
  FROM joined)"""


def round_features(df):
    """Rounding for the comparison only: engines add doubles in different orders."""
    eight = [c for c in df.columns if "cost" in c and "requests" not in c or c in ("avg_cost_per_request", "security_to_perf_ratio")]
    six = [c for c in df.columns if c in ("hour_sin", "hour_cos")]
    return df.withColumns(
        {**{c: F.round(c, 8) for c in eight}, **{c: F.round(c, 6) + F.lit(0.0) for c in six}}
    )


@query("feature_store", f"WITH {features_sql('minute')} SELECT * FROM features")
def _(spark, sf):
    made = all_marts(spark, sf)
    return round_features(features.feature_store(made["cost"], made["performance"], made["security"], SERVICES))


MODELING = """, flags AS (SELECT "timestamp", max(CASE WHEN risk_level = 'alto' THEN 1 ELSE 0 END) AS is_anomaly
  FROM security GROUP BY "timestamp")
SELECT features.*, coalesce(is_anomaly, 0) AS is_anomaly FROM features LEFT JOIN flags USING ("timestamp")"""


@query("modeling_dataset", f"WITH {features_sql('minute')} {MODELING}")
def _(spark, sf):
    made = all_marts(spark, sf)
    return round_features(labels.modeling_dataset(made["cost"], made["performance"], made["security"], SERVICES))


# --- joins and set operations ------------------------------------------------------------------------------------


@query(
    "left_equi_join",
    """WITH m AS (SELECT date_trunc('minute', ts) AS "timestamp", count(*) AS requests FROM events GROUP BY 1)
       SELECT event_id, date_trunc('minute', ts - INTERVAL 1 MINUTE) AS "timestamp", requests
       FROM events LEFT JOIN m ON date_trunc('minute', ts - INTERVAL 1 MINUTE) = m."timestamp" """,
)
def _(spark, sf):
    """Every event with the number of events in the minute before its own, which may have none."""

    def minutes(time):
        return F.date_trunc("minute", time).cast("timestamp_ntz").alias("timestamp")

    events = table(spark, sf, "events")
    counts = events.groupBy(minutes(F.col("ts"))).agg(F.count("*").alias("requests"))
    return features.left_equi_join(events.select("event_id", minutes(F.col("ts") - F.expr("INTERVAL 1 MINUTE"))), counts)


_DOMAIN_PARTS = [
    ("click", "clicks"), ("error", "errors"), ("signup", "signups"), ("purchase", "purchases"), ("view", "views"),
]
_DOMAIN_COUNTS = ", ".join(
    f"""{name} AS (SELECT "timestamp", count(*) AS {name} FROM b WHERE event_type = '{kind}' GROUP BY 1)"""
    for kind, name in _DOMAIN_PARTS
)


@query(
    "full_outer_join_domains",
    f"""WITH b AS (SELECT date_trunc('minute', ts) AS "timestamp", event_type FROM events), {_DOMAIN_COUNTS}
       SELECT "timestamp", {", ".join(name for _, name in _DOMAIN_PARTS)}
       FROM {' FULL OUTER JOIN '.join(name + ' USING ("timestamp")' * (i > 0) for i, (_, name) in enumerate(_DOMAIN_PARTS))}""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select(
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("timestamp"), "event_type"
    )
    return features.full_outer_join_domains(
        [
            events.where(F.col("event_type") == kind).groupBy("timestamp").agg(F.count("*").alias(name))
            for kind, name in _DOMAIN_PARTS
        ]
    )


@query(
    "attach_label",
    f"""WITH {WIDE}, {LABELS},
    hours AS (SELECT date_trunc('hour', o_orderdate) AS "timestamp", count(*) AS orders FROM orders GROUP BY 1
              UNION ALL SELECT "timestamp", sum(requests)::BIGINT FROM performance GROUP BY 1)
    SELECT "timestamp", orders, coalesce(is_anomaly, 0) AS is_anomaly FROM hours LEFT JOIN labels_found USING ("timestamp")""",
)
def _(spark, sf):
    performance = wide_performance(spark, sf)
    orders = table(spark, sf, "orders").groupBy(
        F.date_trunc("hour", "o_orderdate").cast("timestamp_ntz").alias("timestamp")
    ).agg(F.count("*").alias("orders"))
    hours = orders.unionByName(performance.groupBy("timestamp").agg(F.sum("requests").alias("orders")))
    return labels.attach_label(hours, labels.weak_labels(performance, wide_security(spark, sf)))


@query(
    "distinct_union_keys",
    f"""WITH {WIDE} SELECT "timestamp" FROM performance UNION
        SELECT date_trunc('hour', o_orderdate) FROM orders""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.date_trunc("hour", "o_orderdate").cast("timestamp_ntz").alias("timestamp")
    )
    return labels.distinct_union_keys(wide_performance(spark, sf), orders)


_DESCRIBED = [(d, c, t) for d in ("silver", "cost") for c, t in COLUMN_DESCRIPTIONS[d].items()]
_VALUES = ", ".join("('" + "', '".join(x.replace("'", "''") for x in row) + "')" for row in _DESCRIBED)


@query(
    "dictionary_lookup",
    f"""WITH d(dataset, "column", description) AS (VALUES {_VALUES})
    SELECT 'silver' AS dataset, event_type AS "column", count(*) AS n,
           coalesce(any_value(d.description), '{DEFAULT_DESCRIPTIONS["silver"]}') AS description
    FROM (SELECT CASE WHEN event_type = 'click' THEN 'event' WHEN event_type = 'view' THEN 'resource' ELSE event_type END
          AS event_type FROM events) AS e LEFT JOIN d ON d.dataset = 'silver' AND d."column" = event_type GROUP BY event_type""",
)
def _(spark, sf):
    kind = F.col("event_type")
    named = F.when(kind == "click", "event").when(kind == "view", "resource").otherwise(kind)
    counts = table(spark, sf, "events").groupBy(F.lit("silver").alias("dataset"), named.alias("column")).agg(
        F.count("*").alias("n")
    )
    dictionary = profile.description_table(spark, {d: COLUMN_DESCRIPTIONS[d] for d in ("silver", "cost")})
    return profile.dictionary_lookup(counts, dictionary, DEFAULT_DESCRIPTIONS["silver"])


# --- data dictionary ---------------------------------------------------------------------------------------------


def _dictionary_inputs(spark, sf):
    return {"bronze": raw_logs(spark, sf), "silver": silver(spark, sf), **all_marts(spark, sf)}


_COLUMNS = {
    "bronze": "eventtime eventname useridentityaccountid sourceipaddress errorcode requestparameters",
    "silver": "timestamp user_hash event resource hour day_of_week is_weekend masked_ip errorcode requestparameters",
    "cost": "timestamp date hora_completa service requests cost",
    "performance": "timestamp date hora_completa requests unique_users",
    "security": "timestamp date hora_completa user_hash requests requests_zscore is_off_hours risk_level",
}
_TYPES = {
    "timestamp": "timestamp_ntz", "hour": "int", "day_of_week": "int", "is_weekend": "int", "date": "date",
    "requests": "bigint", "unique_users": "bigint", "cost": "double", "requests_zscore": "double", "is_off_hours": "boolean",
}
_SOURCES = {"bronze": "raw_logs", "silver": "silver", "cost": "cost", "performance": "performance", "security": "security"}


def _dictionary_sql() -> str:
    parts = []
    for dataset, names in _COLUMNS.items():
        columns = names.split()
        rows = ", ".join(
            "({0}, '{1}', '{2}', '{3}')".format(
                i, name, _TYPES.get(name, "string"),
                COLUMN_DESCRIPTIONS.get(dataset, {}).get(name, DEFAULT_DESCRIPTIONS["gold"]).replace("'", "''"),
            )
            for i, name in enumerate(columns, start=1)
        )
        parts.append(
            f"""SELECT '{dataset}' AS dataset, n AS n_rows, {len(columns)} AS n_columns, d.*
            FROM (SELECT count(*) AS n FROM {_SOURCES[dataset]}) AS t
            CROSS JOIN (VALUES {rows}) AS d(position, "column", type, description)"""
        )
    return f"WITH {marts_sql()} " + " UNION ALL ".join(parts)


@query("data_dictionary", _dictionary_sql())
def _(spark, sf):
    return profile.data_dictionary(spark, _dictionary_inputs(spark, sf))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _chosen(texts: dict[str, str], default: str) -> str:
    cases = " ".join(f"WHEN {_quoted(name)} THEN {_quoted(text)}" for name, text in texts.items())
    return f"CASE dataset {cases} ELSE {_quoted(default)} END"


_ASKED = {name: "\n".join(f"- {q}" for q in asked) for name, asked in DATASET_QUESTIONS.items()}
DOCUMENTS = f"""WITH profile AS ({_dictionary_sql()})
SELECT dataset, array_to_string([
  '# Documentação do Dataset '||upper(dataset[1])||dataset[2:], '', '## 1. Para que serve', '',
  {_chosen(DATASET_PURPOSES, '')}, '', '## 2. O que este dataset deve responder', '',
  {_chosen(_ASKED, NO_QUESTIONS)}, '', '## 3. Informações gerais', '',
  '- **Quantidade de linhas:** '||any_value(n_rows), '- **Quantidade de colunas:** '||any_value(n_columns),
  '- **Data de geração:** 2024-02-01 00:00:00', '', '## 4. Colunas geradas', '',
  string_agg('- **'||"column"||'**', chr(10) ORDER BY position), '', '## 5. Descrição das colunas', '',
  string_agg('### '||"column"||chr(10)||chr(10)||description||chr(10), chr(10) ORDER BY position)], chr(10)) AS document
FROM profile GROUP BY dataset"""


@query("data_dictionary_documents", DOCUMENTS)
def _(spark, sf):
    return profile.render_documents(profile.data_dictionary(spark, _dictionary_inputs(spark, sf)), "2024-02-01 00:00:00")


# --- sorting, splitting, top-k -----------------------------------------------------------------------------------


@query("sort_by_time", "SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id")
def _(spark, sf):
    return ranking.sort_by_time(table(spark, sf, "events").select("event_id", "ts", "event_type"), "ts", "event_id")


@query("last_n_rows", f'WITH {marts_sql()} SELECT * FROM security ORDER BY "timestamp" DESC, user_hash DESC LIMIT 1500')
def _(spark, sf):
    return ranking.last_n_rows(marts.mart_security(prepared(spark, sf)), ["timestamp", "user_hash"])


@query(
    "temporal_split",
    """SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) <= (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM events)
       AS is_train FROM events""",
)
def _(spark, sf):
    return ranking.temporal_split(table(spark, sf, "events").select("event_id", "ts"), "ts", ["event_id"])


@query(
    "topk_by_score",
    """SELECT user_id, event_id, value, rank FROM (SELECT user_id, event_id, value,
       row_number() OVER (PARTITION BY user_id ORDER BY value, event_id)::INTEGER AS rank FROM events) AS r WHERE rank <= 5""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "value")
    return ranking.topk_per_group(events, ["user_id"], ["value", "event_id"], 5)


# --- evaluation --------------------------------------------------------------------------------------------------

TRUTH = """truth AS (SELECT l.quality AS label, CASE WHEN d.n_chars > 800 THEN 1 ELSE 0 END AS prediction, d.n_chars AS score
  FROM labels l JOIN documents d USING (doc_id))"""
COUNTS = f"""{TRUTH}, cells AS (SELECT
  count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM truth)"""


def truth(spark, sf, limit: int = 800):
    labels_table, documents = table(spark, sf, "labels"), table(spark, sf, "documents").select("doc_id", "n_chars")
    return labels_table.join(documents, "doc_id").select(
        F.col("quality").alias("label"), F.when(F.col("n_chars") > limit, 1).otherwise(0).alias("prediction"),
        F.col("n_chars").alias("score"),
    )


@query(
    "confusion_matrix",
    f"""WITH {COUNTS} SELECT 0 AS truth, tn AS predicted_0, fp AS predicted_1 FROM cells
        UNION ALL SELECT 1, fn, tp FROM cells""",
)
def _(spark, sf):
    return metrics.confusion_matrix(truth(spark, sf))


METRICS = """round((tp + tn) / (tn + fp + fn + tp), 10) AS accuracy, round(tp / (tp + fp), 10) AS precision,
  round(tp / (tp + fn), 10) AS recall, round(2 * tp / (2 * tp + fp + fn), 10) AS f1"""


@query("binary_metrics", f"WITH {COUNTS} SELECT {METRICS} FROM cells")
def _(spark, sf):
    found = metrics.binary_metrics(truth(spark, sf))
    return found.select(*[F.round(c, 10).alias(c) for c in found.columns])


AUC = """SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 10) AS roc_auc FROM (
  SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM (
    SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM truth GROUP BY score) AS g) AS r"""


@query("roc_auc", f"WITH {TRUTH} {AUC}")
def _(spark, sf):
    return metrics.roc_auc(truth(spark, sf)).select(F.round("roc_auc", 10).alias("roc_auc"))


REPORT = """lines AS (
  SELECT '0' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS r, 2 * tn / (2 * tn + fn + fp) AS f, tn + fp AS n FROM cells
  UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), fn + tp FROM cells),
report AS (
  SELECT * FROM lines
  UNION ALL SELECT 'accuracy', NULL, NULL, (tn + tp) / (tn + fp + fn + tp), tn + fp + fn + tp FROM cells
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(n) FROM lines
  UNION ALL SELECT 'weighted avg', sum(p * n) / sum(n), sum(r * n) / sum(n), sum(f * n) / sum(n), sum(n) FROM lines)
SELECT class, round(p, 10) AS precision, round(r, 10) AS recall, round(f, 10) AS f1_score, CAST(n AS DOUBLE) AS support
FROM report"""


def rounded_report(report):
    return report.withColumns({c: F.round(c, 10) for c in ("precision", "recall", "f1_score")})


@query("classification_report", f"WITH {COUNTS}, {REPORT}")
def _(spark, sf):
    return rounded_report(metrics.classification_report(truth(spark, sf)))


@query(
    "positive_rate",
    """SELECT lang AS part, count(*) AS n_rows, 4 AS n_features, round(avg(quality), 10) AS positive_rate
       FROM labels JOIN documents USING (doc_id) GROUP BY lang""",
)
def _(spark, sf):
    joined = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    rates = metrics.positive_rate(joined.withColumnRenamed("lang", "part"), "part", "quality", 4)
    return rates.withColumn("positive_rate", F.round("positive_rate", 10))


