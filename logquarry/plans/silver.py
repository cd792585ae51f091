"""Raw log table to the cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.fixed_values import (
    CLEANED_COLUMNS, CLEANED_OPTIONAL_COLUMNS, CRITICAL_COLUMNS, DEFAULT_DESCRIPTIONS, USER_ID_COLUMNS,
)
from logquarry.functions.columns import calendar_parts, hash_user, mask_ip, parse_utc
from logquarry.functions.names import canonical_event_resource, drop_null, normalize_names, select_present
from logquarry.operators.marts import dedup_full_row
from logquarry.operators.profile import data_dictionary, render_documents
from logquarry.sources.logs import null_tokens_to_null
from logquarry.sources.sinks import write_counted, write_document, write_partitioned
from logquarry.sources.snapshots import read_day


def drop_null_critical(df: DataFrame, columns=CRITICAL_COLUMNS) -> DataFrame:
    return drop_null(df, columns)


def with_user_hash(df: DataFrame, candidates=USER_ID_COLUMNS) -> DataFrame:
    """Hash the first id column that exists; without one every user is `unknown`."""
    source = next((c for c in candidates if c in df.columns), None)
    return df.withColumn("user_hash", hash_user(F.col(source)) if source else F.lit("unknown"))


def with_masked_ip(df: DataFrame, source: str = "sourceipaddress") -> DataFrame:
    return df.withColumn("masked_ip", mask_ip(F.col(source))) if source in df.columns else df


def project_silver(df: DataFrame) -> DataFrame:
    return select_present(df, CLEANED_COLUMNS, CLEANED_OPTIONAL_COLUMNS)


def clean_logs(raw: DataFrame, time_format: str | None = None) -> DataFrame:
    """Distinct rows with a name and a valid time, user ids hashed, addresses masked.

    Whole rows are compared, so the one shuffle carries every raw column. Spark moves the tests on name and
    time in front of it, and drops copies inside each map task.
    """
    df = drop_null_critical(normalize_names(dedup_full_row(raw)))
    timestamp = F.col("timestamp")
    df = df.withColumn("timestamp", parse_utc(F.col("eventtime"), time_format)).where(timestamp.isNotNull())
    df = df.withColumns(calendar_parts(timestamp))
    return project_silver(canonical_event_resource(with_masked_ip(with_user_hash(df))))


def bronze_to_silver(
    spark: SparkSession, bronze: str, silver: str, documents: str, dt: str, generated_at: str,
    time_format: str | None = None,
) -> None:
    """Clean day `dt` of the landed table, replace that day of the cleaned table, and describe it."""
    raw = read_day(spark, bronze, dt)
    n_rows = write_counted(clean_logs(null_tokens_to_null(raw), time_format), write_partitioned, silver, dt)
    stored = read_day(spark, silver, dt)
    facts = {
        "silver": {"Origem": f"{bronze}/dt={dt}", "Destino": f"{silver}/dt={dt}", "Linhas originais": raw.count()}
    }
    profile = data_dictionary(spark, {"silver": stored}, n_rows={"silver": n_rows}, default=DEFAULT_DESCRIPTIONS["silver"])
    write_document(render_documents(profile, generated_at, facts=facts), f"{documents}/dt={dt}")
