"""The driver's tables in the shape of the operators' inputs: once for Spark, once as SQL text for the check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.operators import marts as m
from logquarry.plans.silver import clean_logs

# Up to so many ids travel to all tasks.
MOST_IDS = 2_000_000
EVENT_NAMES = [
    "DescribeInstances", "RunInstances", "GetBucketAcl", "ListBuckets", "GetObject", "GetUser", "AttachRolePolicy",
    "AssumeRole", "StopInstances", "PutObject", "CreateUser", "DecodeMessage",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    return spark.sql(text, **tables)


# --- raw logs: every event once, error events delivered twice, with missing names, bad times, missing ids ----------

_NAME_CASES = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(EVENT_NAMES))


def _raw_logs(events: str, iso: str, text: str) -> str:
    return f"""
SELECT CASE WHEN event_id % 101 = 0 THEN 'not-a-date' ELSE {iso} END AS eventtime,
       CASE CAST(event_id % 13 AS INT) {_NAME_CASES} ELSE NULL END AS eventname,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(user_id AS {text}) END AS useridentityaccountid,
       CASE WHEN event_id % 19 = 0 THEN 'console.example.com'
            ELSE CAST(user_id % 223 AS {text})||'.'||CAST(event_id % 251 AS {text})||'.7.'||CAST(event_id % 13 AS {text})
       END AS sourceipaddress,
       event_type AS errorcode, props AS requestparameters
FROM (SELECT * FROM {events} UNION ALL SELECT * FROM {events} WHERE event_type = 'error') AS delivered"""


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")"""
    return sql(spark, _raw_logs("{events}", iso, "STRING"), events=table(spark, sf_dir, "events"))


RAW_LOGS = f"raw_logs AS ({_raw_logs('events', '''strftime(ts, '%Y-%m-%dT%H:%M:%SZ')''', 'VARCHAR')})"

PARSED = f"""{RAW_LOGS},
parsed AS (
  SELECT *, TRY_CAST(eventtime AS TIMESTAMP) AS t FROM (SELECT DISTINCT * FROM raw_logs) AS once
  WHERE eventname IS NOT NULL AND TRY_CAST(eventtime AS TIMESTAMP) IS NOT NULL)"""

MASKED_IP = """CASE WHEN sourceipaddress IS NULL THEN NULL
  WHEN len(string_split(sourceipaddress, '.')) = 4
  THEN string_split(sourceipaddress, '.')[1]||'.'||string_split(sourceipaddress, '.')[2]||'.***.***'
  ELSE '***' END"""

SILVER = f"""{PARSED},
silver AS (
  SELECT t AS "timestamp", sha256(useridentityaccountid) AS user_hash, eventname AS event, 'unknown' AS resource,
         CAST(hour(t) AS INTEGER) AS hour, CAST(isodow(t) - 1 AS INTEGER) AS day_of_week,
         CASE WHEN isodow(t) >= 6 THEN 1 ELSE 0 END AS is_weekend, {MASKED_IP} AS masked_ip, errorcode, requestparameters
  FROM parsed)"""


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_logs(raw_logs(spark, sf_dir))


# --- marts -------------------------------------------------------------------------------------------------------

SERVICE = """CASE WHEN regexp_matches(event, '^(Describe|Run|Start|Stop|Terminate)') THEN 'ec2'
  WHEN regexp_matches(event, '^(GetBucket|PutBucket|GetObject|PutObject|List)') THEN 's3'
  WHEN regexp_matches(event, '^(GetUser|GetRole|GetPolicy|CreateUser|Attach)') THEN 'iam'
  ELSE 'other_services' END"""


def prepared_sql(grain: str) -> str:
    return f"""{SILVER},
prepared AS (
  SELECT coalesce(event, 'unknown') AS event, coalesce(user_hash, 'unknown') AS user_hash,
         date_trunc('{grain}', "timestamp") AS bucket FROM silver)"""


BUCKET_COLUMNS = """bucket AS "timestamp", CAST(bucket AS DATE) AS date, strftime(bucket, '%H:%M') AS hora_completa"""


def marts_sql(grain: str = "minute") -> str:
    return f"""{prepared_sql(grain)},
cost AS (
  SELECT {BUCKET_COLUMNS}, service, count(*) AS requests, round_even(count(*) * CAST(0.000004 AS DOUBLE), 8) AS cost
  FROM (SELECT bucket, {SERVICE} AS service FROM prepared) AS s GROUP BY bucket, service),
performance AS (
  SELECT {BUCKET_COLUMNS}, count(*) AS requests, count(DISTINCT user_hash) AS unique_users
  FROM prepared GROUP BY bucket),
by_user AS (SELECT bucket, user_hash, count(*) AS requests FROM prepared GROUP BY bucket, user_hash),
scored AS (
  SELECT *, CASE WHEN coalesce((SELECT stddev_samp(requests) FROM by_user), 0) = 0 THEN 0.0
    ELSE round_even((requests - (SELECT avg(requests) FROM by_user)) / (SELECT stddev_samp(requests) FROM by_user), 4)
         + 0.0 END AS requests_zscore FROM by_user),
security AS (
  SELECT {BUCKET_COLUMNS}, user_hash, requests, CAST(requests_zscore AS DOUBLE) AS requests_zscore,
         hour(bucket) IN (0, 1, 2, 3, 4, 5, 23) AS is_off_hours,
         CASE WHEN requests_zscore > 2.5 THEN 'alto' ELSE 'normal' END AS risk_level FROM scored)"""


def prepared(spark: SparkSession, sf_dir: str, grain: str = "minute") -> DataFrame:
    return m.prepare_events(silver(spark, sf_dir), grain)


def marts(spark: SparkSession, sf_dir: str, grain: str = "minute") -> dict[str, DataFrame]:
    return m.marts_from_counts(m.count_events(prepared(spark, sf_dir, grain)))


# --- marts with the optional columns, per hour and event type or user -------------------------------------------------


def _wide_performance(events: str, ntz: str, text: str) -> str:
    return f"""
SELECT CAST(date_trunc('hour', ts) AS {ntz}) AS "timestamp", count(*) AS requests,
       count(DISTINCT user_id) AS unique_users, count(DISTINCT props) AS unique_resources,
       max(value) AS requests_growth_pct, min(value) AS rolling_requests_3,
       CASE WHEN max(value) > 200 THEN 'Pico' WHEN max(value) > 150 THEN 'ANOMALO' ELSE 'estavel' END AS performance_status,
       CASE WHEN count(*) >= 7 THEN ' True ' WHEN count(*) >= 6 THEN '1' WHEN count(*) >= 5 THEN 'yes' ELSE NULL END AS is_peak
FROM {events} GROUP BY date_trunc('hour', ts), event_type"""


def _wide_security(events: str, ntz: str, text: str) -> str:
    return f"""
SELECT CAST(date_trunc('hour', ts) AS {ntz}) AS "timestamp", CAST(user_id AS {text}) AS user_hash, count(*) AS requests,
       count(CASE WHEN event_type = 'error' THEN 1 END) AS rare_events_count,
       CASE WHEN min(value) < 5 THEN 'n/d' ELSE CAST(count(CASE WHEN event_type = 'error' THEN 1 END) * 4 AS {text}) END
         AS rare_events_ratio_pct,
       CASE WHEN min(event_type) = 'view' THEN NULL ELSE max(event_type) END AS dominant_event,
       CASE WHEN max(value) > 200 THEN 'Crítico' WHEN max(value) > 150 THEN 'medio' ELSE 'normal' END AS risk_level,
       CASE WHEN max(value) > 250 THEN 'TRUE' ELSE 'false' END AS is_unusual_access
FROM {events} GROUP BY date_trunc('hour', ts), user_id"""


WIDE = f"""performance AS ({_wide_performance('events', 'TIMESTAMP', 'VARCHAR')}),
security AS ({_wide_security('events', 'TIMESTAMP', 'VARCHAR')})"""


def wide_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _wide_performance("{events}", "TIMESTAMP_NTZ", "STRING").replace('"', "`")
    return sql(spark, text, events=table(spark, sf_dir, "events"))


def wide_security(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _wide_security("{events}", "TIMESTAMP_NTZ", "STRING").replace('"', "`")
    return sql(spark, text, events=table(spark, sf_dir, "events"))


# --- documents, questions, vectors ---------------------------------------------------------------------------------

_HEADED = "'# D'||CAST(doc_id AS {text})||chr(10)||replace(text,'. ','.'||chr(10)||'## ')"
MD_DOCUMENTS = f"md_documents AS (SELECT doc_id, {_HEADED.format(text='VARCHAR')} AS text FROM documents)"


def md_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.selectExpr("doc_id", f"{_HEADED.format(text='STRING')} AS text")


_QUESTION = """CASE CAST(conv_id % 9 AS INT) WHEN 0 THEN 'Quem é você? ' WHEN 1 THEN 'Quais MÉTRICAS '
  WHEN 2 THEN 'Pré-processamento ' WHEN 3 THEN 'camada Bronze ' WHEN 4 THEN 'Riscos de Segurança ' WHEN 5 THEN 'Custo '
  WHEN 6 THEN 'Tráfego ' WHEN 7 THEN 'a Pipeline ' ELSE '' END || text"""
QUESTIONS = f"""questions AS (
  SELECT conv_id*100+turn AS question_id, {_QUESTION} AS question FROM conversations WHERE role='user')"""


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "conversations").where("role = 'user'")
    return users.selectExpr("conv_id*100+turn AS question_id", f"{_QUESTION} AS question")


_DOMAIN = """CASE CAST(e.label AS INT) WHEN 0 THEN 'cost' WHEN 1 THEN 'performance' WHEN 2 THEN 'security'
  WHEN 3 THEN 'documentation_bronze' WHEN 4 THEN 'documentation_silver' WHEN 5 THEN 'documentation_gold_cost'
  WHEN 6 THEN 'documentation_gold_performance' WHEN 7 THEN 'documentation_gold_security'
  ELSE 'documentation_project' END"""
# Project texts open with one of the section headings, so that the marker filter has something to keep.
_MARKED = """CASE WHEN e.label >= 8 THEN CASE CAST(e.vec_id % 4 AS INT) WHEN 0 THEN '## Quem e o assistente'
  WHEN 1 THEN '## Modelos treinados' WHEN 2 THEN '## Pre-processamento dos dados' ELSE '## Outros' END || chr(10)
  ELSE '' END || d.text"""


def _corpus(embeddings: str, documents: str) -> str:
    return f"""SELECT e.vec_id AS id, {_DOMAIN} AS domain, {_MARKED} AS text, e.embedding AS embedding
FROM {embeddings} e JOIN {documents} d ON e.vec_id = d.doc_id"""


def _question_vectors(conversations: str, embeddings: str) -> str:
    return f"""SELECT question_id, e.embedding AS q
FROM (SELECT conv_id*100+turn AS question_id, (conv_id*7+turn) % (SELECT count(*) FROM {embeddings}) AS vec_id
      FROM {conversations} WHERE role='user') AS c JOIN {embeddings} e ON e.vec_id = c.vec_id"""


CORPUS = f"corpus AS ({_corpus('embeddings', 'documents')})"
QUESTION_VECTORS = f"question_vectors AS ({_question_vectors('conversations', 'embeddings')})"


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings, documents = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "documents")
    if embeddings.count() <= MOST_IDS:
        # Texts without a vector are left behind before the join moves texts.
        documents = documents.join(F.broadcast(embeddings.select("vec_id")), F.col("doc_id") == F.col("vec_id"), "left_semi")
    return sql(spark, _corpus("{embeddings}", "{documents}"), embeddings=embeddings, documents=documents)


def question_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(
        spark, _question_vectors("{conversations}", "{embeddings}"),
        embeddings=table(spark, sf_dir, "embeddings"), conversations=table(spark, sf_dir, "conversations"),
    )


def questions_with_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions(spark, sf_dir).join(question_vectors(spark, sf_dir), "question_id")


FOLDED = "trim(regexp_replace(strip_accents(lower({x})), '\\s+', ' ', 'g'))"

INTENT = """CASE
  WHEN contains(f,'quem e voce') OR contains(f,'quem voce e') THEN 'identity'
  WHEN contains(f,'modelo treinado') OR contains(f,'modelos treinados') OR contains(f,'modelos foram treinados')
    OR contains(f,'metrica') THEN 'models_metrics'
  WHEN contains(f,'pre processamento') OR contains(f,'pre-processamento') THEN 'preprocessing'
  WHEN contains(f,'bronze') OR contains(f,'ingest') THEN 'documentation_bronze'
  WHEN contains(f,'silver') THEN 'documentation_silver'
  WHEN contains(f,'gold') THEN 'documentation_gold'
  WHEN contains(f,'pipeline') OR contains(f,'camada') OR contains(f,'processamento') OR contains(f,'processo')
    THEN 'documentation_pipeline'
  WHEN contains(f,'seguranca') OR contains(f,'risco') OR contains(f,'alerta') OR contains(f,'acesso fora') THEN 'security'
  WHEN contains(f,'custo') OR contains(f,'cost') OR contains(f,'servico mais caro') THEN 'cost'
  WHEN contains(f,'performance') OR contains(f,'desempenho') OR contains(f,'trafego') OR contains(f,'usuarios unicos')
    THEN 'performance'
  ELSE 'general' END"""

ASKED = f"""{QUESTIONS},
asked AS (SELECT *, {INTENT} AS intent FROM (SELECT *, {FOLDED.format(x='question')} AS f FROM questions) AS folded)"""

ROUTES = """routes(intent, domain) AS (VALUES
  ('identity', 'documentation_project'), ('models_metrics', 'documentation_project'),
  ('preprocessing', 'documentation_project'), ('documentation_bronze', 'documentation_bronze'),
  ('documentation_silver', 'documentation_silver'), ('documentation_gold', 'documentation_gold_cost'),
  ('documentation_gold', 'documentation_gold_performance'), ('documentation_gold', 'documentation_gold_security'),
  ('documentation_pipeline', 'documentation_bronze'), ('documentation_pipeline', 'documentation_silver'),
  ('documentation_pipeline', 'documentation_gold_cost'), ('documentation_pipeline', 'documentation_gold_performance'),
  ('documentation_pipeline', 'documentation_gold_security'))"""

DISTANCE = "list_sum(list_transform(list_zip(c.embedding, v.q), lambda p: pow(CAST(p[1] AS DOUBLE)-CAST(p[2] AS DOUBLE), 2)))"
