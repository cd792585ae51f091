"""Cleaned table to the three marts, their exports and their documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logquarry.operators.marts import count_events, marts_from_counts, prepare_events
from logquarry.operators.profile import data_dictionary, render_documents
from logquarry.sources.sinks import export_csv, write_counted, write_document, write_partitioned
from logquarry.sources.snapshots import read_day, read_expected_or_last_day


def build_marts(cleaned: DataFrame, grain: str = "minute") -> dict[str, DataFrame]:
    return marts_from_counts(count_events(prepare_events(cleaned, grain)))


def silver_to_gold(
    spark: SparkSession, silver: str, gold: str, dt: str, generated_at: str, csv: bool = True
) -> dict[str, DataFrame]:
    """Write the marts of day `dt` below `gold` and return them as read back.

    Events are counted once into `gold/event_counts`; the marts, their text exports and the documents only read
    that small table and the marts themselves; their rows are counted from file footers.
    """
    cleaned = read_expected_or_last_day(spark, silver, dt)
    counts = count_events(prepare_events(cleaned))
    write_partitioned(counts, f"{gold}/event_counts", dt)
    marts = marts_from_counts(read_day(spark, f"{gold}/event_counts", dt))
    stored, n_rows = {}, {}
    for domain, mart in marts.items():
        n_rows[domain] = write_counted(mart, write_partitioned, f"{gold}/{domain}", dt)
        stored[domain] = read_day(spark, f"{gold}/{domain}", dt)
        if csv:
            export_csv(stored[domain], f"{gold}/csv/{domain}/dt={dt}")
    write_document(render_documents(data_dictionary(spark, stored, n_rows=n_rows), generated_at), f"{gold}/documents/dt={dt}")
    return stored
