"""Writers: dated tables, text exports, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_bronze_raw(df: DataFrame, path: str, dt: str) -> None:
    """Land every column unchanged as text in partition `dt`."""
    write_partitioned(df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]), path, dt)


def write_partitioned(df: DataFrame, path: str, dt: str) -> None:
    """Write partition `dt`; a rerun for the same day replaces that day only."""
    (
        df.withColumn("dt", F.lit(dt))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )


def write_counted(df: DataFrame, write: Callable[[DataFrame, str, str], None], path: str, dt: str) -> int:
    """`write(df, path, dt)`, and the rows of that day as the footers of its files tell: no column is read for it.

    An `Observation` of the write is no way to count: once a session has one, models with a training summary, which hold
    their session, cannot be sent to tasks any more.
    """
    write(df, path, dt)
    return df.sparkSession.read.schema("dt STRING").parquet(path).where(F.col("dt") == dt).count()


def export_frame(df: DataFrame) -> DataFrame:
    """Text form of a mart: times as `yyyy-MM-dd HH:mm:ss`, `cost` with eight decimals."""
    columns = []
    for name, dtype in df.dtypes:
        column = F.col(f"`{name}`")
        if dtype in ("timestamp", "timestamp_ntz"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif name == "cost":
            column = F.format_string("%.8f", column.cast("double"))
        columns.append(column.alias(name))
    return df.select(*columns)


def export_csv(df: DataFrame, path: str, byte_order_mark: bool = False) -> None:
    """Semicolon-separated UTF-8 with header, every file headed by a byte-order mark if asked for."""
    frame = export_frame(df)
    if byte_order_mark:
        frame = frame.withColumnRenamed(frame.columns[0], "\ufeff" + frame.columns[0])
    frame.write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    text = F.col("timestamp").cast("string").alias("timestamp")
    predictions.select(text, "prediction", "score").write.mode("overwrite").option("header", True).csv(path)


def rank_models(runs: DataFrame) -> DataFrame:
    """One row per model, best F1 first."""
    return runs.orderBy(F.desc("f1"), "model")


def write_run_summary(runs: DataFrame, path: str) -> None:
    rank_models(runs).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_document(documents: DataFrame, path: str) -> None:
    """One text file row per document (column `document`), partitioned by dataset."""
    documents.select("dataset", F.col("document").alias("value")).write.mode("overwrite").partitionBy(
        "dataset"
    ).option("lineSep", "\n").text(path)
