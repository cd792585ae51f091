"""Imputation, scaling and one-hot coding, fitted on training rows and kept as a Spark ML pipeline."""

from __future__ import annotations

import sys

from pyspark.ml import PipelineModel
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.functions.names import split_columns_by_dtype
from logquarry.operators.ranking import exact_quantiles

EPSILON = sys.float_info.epsilon
# Categories become model size: a column of more is hashed to so many places.
MAX_CATEGORIES = 100_000


def numeric(name: str) -> Column:
    """Column as double with NaN as NULL."""
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def fit_medians(train: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact medians; a column without any value has none."""
    return exact_quantiles(train.select(*[numeric(c).alias(c) for c in columns]), columns, 0.5)


def impute_median(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(numeric(c), F.lit(m)) for c, m in medians.items()})


def fit_scales(imputed: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per column in one aggregation; a constant column gets deviation 1.

    Constant includes columns whose spread is within the rounding of doubles, such as a ratio that is the same
    everywhere: dividing by that spread would blow rounding noise up to unit size.
    """
    row = imputed.agg(
        *[
            F.struct(
                F.avg(f"`{c}`").alias("mean"), F.stddev_pop(f"`{c}`").alias("deviation"), F.count(f"`{c}`").alias("n")
            ).alias(c)
            for c in columns
        ]
    ).first()
    scales = {}
    for name in columns:
        n, mean, variance = row[name]["n"], row[name]["mean"], row[name]["deviation"] ** 2
        constant = variance <= n * EPSILON * variance + (n * mean * EPSILON) ** 2
        scales[name] = (mean, 1.0 if constant else row[name]["deviation"])
    return scales


def standard_scale(df: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(f"`{c}`") - F.lit(mean)) / F.lit(dev) for c, (mean, dev) in scales.items()})


def fit_modes(train: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest on a tie; values are counted before they are compared."""
    if not columns:
        return {}
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    rows = train.select(F.explode(F.array(*cells)).alias("cell")).where("cell.value IS NOT NULL")
    counts = rows.groupBy("cell.feature", "cell.value").count()
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("count")).alias("n"), "value")).alias("best"))
    found = {r["feature"]: r["best"]["value"] for r in best.collect()}  # one row per column
    return {c: found[c] for c in columns if c in found}


def impute_mode(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(m)) for c, m in modes.items()})


def category_counts(train: DataFrame, columns: list[str], most: int = MAX_CATEGORIES) -> dict[str, int]:
    """Exact number of categories per column, counted up to one more than `most`."""
    return {c: train.select(F.col(f"`{c}`").cast("string").alias("v")).where("v IS NOT NULL").distinct().limit(most + 1).count() for c in columns}


def one_hot_stages(train: DataFrame, columns: list[str], most: int = MAX_CATEGORIES) -> list:
    """Fitted stages that code each column as `<column>__hot`.

    A column of at most `most` categories gets one place per category; one not seen in training is coded as all zeros. A
    column of more is hashed to `most` places, so that it costs no table of categories, however many there are.
    """
    counts = category_counts(train, columns, most)
    listed, hashed = [c for c in columns if counts[c] <= most], [c for c in columns if counts[c] > most]
    stages = [FeatureHasher(inputCols=[c], outputCol=f"{c}__hot", numFeatures=most, categoricalCols=[c]) for c in hashed]
    if listed:
        indexer = StringIndexer(
            inputCols=listed, outputCols=[f"{c}__index" for c in listed], handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ).fit(train)
        encoder = OneHotEncoder(
            inputCols=[f"{c}__index" for c in listed], outputCols=[f"{c}__hot" for c in listed], dropLast=True
        ).fit(indexer.transform(train))
        stages += [indexer, encoder]
    return stages


def _literal(value: float) -> str:
    return f"({float(value)!r}D)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_preprocessor(train: DataFrame, features: list[str]) -> PipelineModel:
    """Numeric columns: median then standard scaling; others: most frequent value then one-hot.

    The fitted numbers are constants in one SELECT stage, so the result is saved and loaded by Spark ML
    itself. Columns without any training value are left out.
    """
    numeric_columns, categorical = split_columns_by_dtype(train.select(*[f"`{c}`" for c in features]))
    medians = fit_medians(train, numeric_columns) if numeric_columns else {}
    scales = fit_scales(impute_median(train, medians), list(medians)) if medians else {}
    modes = fit_modes(train, categorical)
    parts = ["*"]
    for name, median in medians.items():
        mean, deviation = scales[name]
        value = f"cast(`{name}` as double)"
        known = f"CASE WHEN NOT isnan({value}) THEN {value} END"
        parts.append(
            f"(coalesce({known}, {_literal(median)}) - {_literal(mean)}) / {_literal(deviation)} AS `{name}__scaled`"
        )
    for name, mode in modes.items():
        parts.append(f"coalesce(cast(`{name}` as string), {_text(mode)}) AS `{name}__filled`")
    select = SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")
    stages, inputs = [select], [f"{c}__scaled" for c in medians]
    if modes:
        filled = [f"{c}__filled" for c in modes]
        stages += one_hot_stages(select.transform(train), filled)
        inputs += [f"{c}__hot" for c in filled]
    return PipelineModel([*stages, VectorAssembler(inputCols=inputs, outputCol="features")])
