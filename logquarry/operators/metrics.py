"""Evaluation of binary predictions; every table here is a few rows made by one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.operators.ranking import with_running_totals

CELLS = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row (tn, fp, fn, tp)."""
    return df.agg(
        *[
            F.count(F.when((F.col(label) == truth) & (F.col(prediction) == guess), 1)).alias(cell)
            for cell, (truth, guess) in CELLS.items()
        ]
    )


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows are the truth, `predicted_0` and `predicted_1` the predictions."""
    counts = confusion_counts(df, label, prediction)
    rows = F.array(
        F.struct(F.lit(0).alias("truth"), F.col("tn").alias("predicted_0"), F.col("fp").alias("predicted_1")),
        F.struct(F.lit(1).alias("truth"), F.col("fn").alias("predicted_0"), F.col("tp").alias("predicted_1")),
    )
    return counts.select(F.inline(rows))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def _prf(hits: Column, predicted: Column, actual: Column) -> tuple[Column, Column, Column]:
    # F1 as 2TP / (predicted + actual) is the harmonic mean without a second division.
    return _ratio(hits, predicted), _ratio(hits, actual), _ratio(2 * hits, predicted + actual)


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of (tn, fp, fn, tp) rows; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    precision, recall, f1 = _prf(tp, tp + fp, tp + fn)
    return counts.withColumns(
        {
            "accuracy": _ratio(tp + tn, tn + fp + fn + tp),
            "precision": precision,
            "recall": recall,
            "f1": f1,
        }
    ).drop(*CELLS)


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return metrics_from_counts(confusion_counts(df, label, prediction))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL when the truth holds one class only. A missing score,
    NULL or NaN, is an error.

    Rows are counted per distinct score before anything is ordered. All sums are whole numbers, so the result
    does not depend on how the data is partitioned.
    """
    value = F.col(score).cast("double")
    missing = F.raise_error(F.lit(f"Column {score} has missing scores"))
    by_score = (
        df.groupBy(F.when(value.isNull() | F.isnan(value), missing.cast("double")).otherwise(value).alias("score"))
        .agg(
            F.count(F.when(F.col(label) == 1, 1)).alias("positives"),
            F.count(F.when(F.col(label) == 0, 1)).alias("negatives"),
        )
    )
    scores = df.select(F.col(score).alias("score"))
    ranked = with_running_totals(by_score, "score", {"negatives_below": "negatives"}, bounds_of=scores)
    whole = "decimal(38,0)"
    twice = F.col("positives").cast("decimal(19,0)") * (2 * F.col("negatives_below") + F.col("negatives")).cast(
        "decimal(19,0)"
    )
    totals = ranked.agg(
        F.sum(twice.cast(whole)).cast("double").alias("u"),
        F.sum("positives").cast("double").alias("p"),
        F.sum("negatives").cast("double").alias("n"),
    )
    pairs = F.col("p") * F.col("n")
    return totals.select(F.when(pairs > 0, F.col("u") / (2 * pairs)).alias("roc_auc"))


def report_from_counts(counts: DataFrame) -> DataFrame:
    """Per class, macro and support-weighted precision, recall, F1 and support, plus accuracy (in `f1_score`).

    Classes seen neither in the truth nor among the predictions are left out, also from the averages.
    """
    tn, fp, fn, tp = (F.col(c) for c in CELLS)

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1_score"), support.cast("double").alias("support"),
        )

    zero, one = _prf(tn, tn + fn, tn + fp), _prf(tp, tp + fp, tp + fn)
    n0, n1, n = tn + fp, fn + tp, tn + fp + fn + tp
    seen0, seen1 = tn + fp + fn > 0, tp + fp + fn > 0
    accuracy = _ratio(tn + tp, n)
    k = F.when(seen0, 1).otherwise(0) + F.when(seen1, 1).otherwise(0)
    macro = [_ratio(F.when(seen0, a).otherwise(0.0) + F.when(seen1, b).otherwise(0.0), k) for a, b in zip(zero, one)]
    weighted = [_ratio(a * n0 + b * n1, n) for a, b in zip(zero, one)]
    lines = F.array(
        F.when(seen0, line("0", *zero, n0)),
        F.when(seen1, line("1", *one, n1)),
        line("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), accuracy, n),
        line("macro avg", *macro, n),
        line("weighted avg", *weighted, n),
    )
    return counts.select(F.inline(F.filter(lines, lambda row: row.isNotNull())))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return report_from_counts(confusion_counts(df, label, prediction))


def positive_rate(df: DataFrame, part: str, label: str, n_features: int) -> DataFrame:
    """(part, n_rows, n_features, positive_rate) per part, e.g. training and test rows."""
    return df.groupBy(part).agg(
        F.count("*").alias("n_rows"),
        F.lit(n_features).alias("n_features"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"),
    )
