"""Readers: raw log CSV, Parquet, and suffix-dispatched tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.fixed_values import NULL_TOKENS
from logquarry.sources.records import scan_records

MART_SCHEMAS = {
    "cost": "timestamp TIMESTAMP_NTZ, date DATE, hora_completa STRING, service STRING, requests BIGINT, cost DOUBLE",
    "performance": "timestamp TIMESTAMP_NTZ, date DATE, hora_completa STRING, requests BIGINT, unique_users BIGINT",
    "security": (
        "timestamp TIMESTAMP_NTZ, date DATE, hora_completa STRING, user_hash STRING, requests BIGINT, "
        "requests_zscore DOUBLE, is_off_hours BOOLEAN, risk_level STRING"
    ),
}


def null_tokens_to_null(df: DataFrame, tokens=NULL_TOKENS) -> DataFrame:
    """Every string cell that is one of `tokens` becomes NULL."""
    if not tokens:
        return df
    return df.select(
        *[
            F.when(F.col(f"`{name}`").isin(tokens), None).otherwise(F.col(f"`{name}`")).alias(name)
            if dtype == "string"
            else F.col(f"`{name}`")
            for name, dtype in df.dtypes
        ]
    )


def scan_log_csv(
    spark: SparkSession, path: str, sep: str = ",", multi_line: bool | None = None, null_tokens=NULL_TOKENS
) -> DataFrame:
    """Header CSV to an all-STRING table; nothing is inferred.

    Cells may hold quoted line breaks, and files are split all the same: the lines are looked through for cells that stay
    open, and where there are any, records are put together from the lines (`sources.records`). `multi_line` True or False
    leaves the files to Spark's reader, which takes a file with line breaks as one task.
    """
    reader = (
        spark.read.option("header", True).option("quote", '"').option("escape", '"').option("sep", sep)
    )
    raw = scan_records(spark, path, sep) if multi_line is None else None
    if raw is None:
        raw = reader.option("multiLine", bool(multi_line)).csv(path)
    return null_tokens_to_null(raw, null_tokens)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sniff_delimiter(spark: SparkSession, path: str, candidates=(",", ";", "\t", "|")) -> str:
    """The candidate that occurs most often in the header line."""
    header = spark.read.text(path).limit(1).collect()
    line = header[0][0].lstrip("\ufeff") if header else ""
    return max(candidates, key=line.count)


def scan_auto(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet or CSV by suffix. CSV cells stay text unless a DDL `schema` names their types."""
    lowered = path.lower().rstrip("/")
    if lowered.endswith(".parquet"):
        return scan_parquet(spark, path)
    if not lowered.endswith(".csv"):
        raise ValueError(f"Unsupported file type: {path}")
    table = scan_log_csv(spark, path, sep=sniff_delimiter(spark, path))
    if schema is None:
        return table
    types = dict(spark.createDataFrame([], schema).dtypes)
    return table.select(
        *[
            F.expr(f"try_cast(`{name}` AS {types[name]})").alias(name) if name in types else F.col(f"`{name}`")
            for name in table.columns
        ]
    )
