"""A raw log file to the landed table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from logquarry.operators.profile import data_dictionary, render_documents
from logquarry.sources.logs import scan_log_csv
from logquarry.sources.sinks import write_bronze_raw, write_counted, write_document
from logquarry.sources.snapshots import read_day


def csv_to_bronze(
    spark: SparkSession, source: str, bronze: str, documents: str, dt: str, generated_at: str, **csv_options
) -> None:
    """Land every column and cell of the file as text in day `dt`, and describe what was landed.

    Cells are kept as written; missing-value texts are only read as NULL when the day is cleaned.
    """
    n_rows = write_counted(scan_log_csv(spark, source, null_tokens=(), **csv_options), write_bronze_raw, bronze, dt)
    landed = read_day(spark, bronze, dt)
    facts = {"bronze": {"Arquivo de origem": source, "Destino": f"{bronze}/dt={dt}"}}
    profile = data_dictionary(spark, {"bronze": landed}, n_rows={"bronze": n_rows})
    write_document(render_documents(profile, generated_at, facts=facts), f"{documents}/dt={dt}")
