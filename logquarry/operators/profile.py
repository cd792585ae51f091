"""Data dictionary: one row per (dataset, column), and the document rendered from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.fixed_values import (
    COLUMN_DESCRIPTIONS, DATASET_PURPOSES, DATASET_QUESTIONS, DEFAULT_DESCRIPTIONS, DOCUMENT_OUTLINE, NO_QUESTIONS,
)
from logquarry.functions.text import fill

DICTIONARY_SCHEMA = "dataset STRING, column STRING, description STRING"


def description_table(spark: SparkSession, descriptions=COLUMN_DESCRIPTIONS) -> DataFrame:
    rows = [(d, c, text) for d, columns in descriptions.items() for c, text in columns.items()]
    return spark.createDataFrame(rows, DICTIONARY_SCHEMA)


def dictionary_lookup(profile: DataFrame, dictionary: DataFrame, default: str) -> DataFrame:
    """Attach each column's description, or the default. The dictionary is a fixed, hand-written table."""
    return profile.join(F.broadcast(dictionary), ["dataset", "column"], "left").withColumn(
        "description", F.coalesce("description", F.lit(default))
    )


def profile_columns(datasets: dict[str, DataFrame], n_rows: dict[str, int] | None = None) -> DataFrame:
    """(dataset, n_rows, n_columns, position, column, type) for each dataset: one count per dataset.

    Datasets whose rows were counted when they were written (`n_rows`) are not read again.
    """
    parts = []
    for name, df in datasets.items():
        columns = F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("type")
                )
                for i, (c, t) in enumerate(df.dtypes, start=1)
            ]
        )
        known = (n_rows or {}).get(name)
        counted = df.agg(F.count("*").alias("n_rows")) if known is None else df.sparkSession.range(1).select(F.lit(known).cast("long").alias("n_rows"))
        parts.append(
            counted
            .select(F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
                    F.explode(columns).alias("c"))
            .select("dataset", "n_rows", "n_columns", "c.position", "c.column", "c.type")
        )
    return reduce(DataFrame.unionByName, parts)


def data_dictionary(
    spark: SparkSession, datasets: dict[str, DataFrame], descriptions=COLUMN_DESCRIPTIONS,
    default: str = DEFAULT_DESCRIPTIONS["gold"], n_rows: dict[str, int] | None = None,
) -> DataFrame:
    return dictionary_lookup(profile_columns(datasets, n_rows), description_table(spark, descriptions), default)


def _per_dataset(texts: dict[str, str], default: str) -> Column:
    chosen = F.lit(default)
    for name, text in texts.items():
        chosen = F.when(F.col("dataset") == name, text).otherwise(chosen)
    return chosen


def render_documents(
    profile: DataFrame, generated_at: str, purposes=DATASET_PURPOSES, questions=DATASET_QUESTIONS,
    facts: dict[str, dict[str, object]] | None = None, outline=DOCUMENT_OUTLINE,
) -> DataFrame:
    """One Markdown document per dataset; `facts` adds lines such as source and destination to its general section.

    A group is one dataset's column list, bounded by its schema.
    """
    purpose = _per_dataset(purposes, "")
    asked = _per_dataset(
        {name: "\n".join(f"- {text}" for text in texts) for name, texts in questions.items()}, NO_QUESTIONS
    )
    extra = _per_dataset(
        {name: "".join(f"\n- **{k}:** {v}" for k, v in known.items()) for name, known in (facts or {}).items()}, ""
    )
    columns = F.array_sort(F.collect_list(F.struct("position", "column", "description")))
    grouped = profile.groupBy("dataset", "n_rows", "n_columns").agg(columns.alias("columns"))
    names = F.transform("columns", lambda c: F.concat(F.lit("- **"), c["column"], F.lit("**")))
    described = F.transform(
        "columns", lambda c: F.concat(F.lit("### "), c["column"], F.lit("\n\n"), c["description"], F.lit("\n"))
    )
    document = fill(
        "\n\n".join(outline),
        title=F.initcap("dataset"), purpose=purpose, questions=asked, n_rows=F.col("n_rows"),
        n_columns=F.col("n_columns"), generated_at=F.lit(generated_at), facts=extra,
        columns=F.array_join(names, "\n"), descriptions=F.array_join(described, "\n"),
    )
    return grouped.select("dataset", document.alias("document"))
