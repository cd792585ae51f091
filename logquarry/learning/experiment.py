"""Train and evaluate all models on a temporal split of the modelling table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.fixed_values import SUPERVISED_PROBLEM, TEST_SIZE, UNSUPERVISED_PROBLEM
from logquarry.learning import models
from logquarry.learning.forest import clipped_contamination, fit_isolation_forest
from logquarry.learning.preprocess import fit_preprocessor
from logquarry.operators.features import KEY
from logquarry.operators.metrics import (
    binary_metrics, classification_report, confusion_counts, confusion_matrix, metrics_from_counts, roc_auc,
)
from logquarry.operators.ranking import temporal_split
from logquarry.sources.sinks import rank_models, write_json, write_run_summary

LABEL = "is_anomaly"
SUPERVISED = ["logistic_regression", "random_forest", "hist_gradient_boosting"]
RUN_SCHEMA = "model string, accuracy double, precision double, recall double, f1 double, roc_auc double"
REGISTRY_SCHEMA = "run string, kind string, key string, value string"


def evaluate(predictions: DataFrame, label: str = LABEL) -> dict:
    """Metrics of (label, prediction, score) rows; `roc_auc` is absent when the truth holds one class."""
    found = binary_metrics(predictions, label).first().asDict()
    area = roc_auc(predictions, label).first()[0]
    return {**found, "roc_auc": area} if area is not None else found


def registry_rows(run: str, tags: dict, params: dict, metrics: dict) -> list[tuple]:
    """(run, kind, key, value) rows of one run."""
    return [
        (run, kind, key, str(value))
        for kind, facts in (("tag", tags), ("param", params), ("metric", metrics))
        for key, value in facts.items()
    ]


@dataclass
class Experiment:
    summary: DataFrame
    registry: DataFrame
    predictions: DataFrame
    reports: dict[str, DataFrame]
    confusion: dict[str, DataFrame]


def run_experiment(
    spark: SparkSession, dataset: DataFrame, out: str, test_size: float = TEST_SIZE, options: dict | None = None,
    supervised=tuple(SUPERVISED),
) -> Experiment:
    """Fit every model on the older rows, score the newer ones, and write models, reports and summary below `out`.

    `out` must be a folder all executors share: the modelling table is stored there once, because every fit
    reads it many times and a lost executor must not rebuild it from the raw marts.

    The models do not depend on each other and are fitted side by side: boosting is a chain of over a thousand short
    jobs, between which the cores are free for the others.
    """
    options = options or {}
    dataset.write.mode("overwrite").parquet(f"{out}/dataset")
    stored = temporal_split(spark.read.parquet(f"{out}/dataset"), KEY, test_size=test_size)
    train, test = (stored.where(c).drop("is_train") for c in (F.col("is_train"), ~F.col("is_train")))
    features = [c for c in dataset.columns if c not in (KEY, LABEL)]
    facts = {
        row["is_train"]: row
        for row in stored.groupBy("is_train").agg(F.count("*").alias("n"), F.avg(LABEL).alias("rate")).collect()
    }
    rows = {part: facts[part]["n"] if part in facts else 0 for part in (True, False)}
    params = {
        "n_rows": rows[True] + rows[False], "train_rows": rows[True], "test_rows": rows[False],
        "n_features": len(features),
    }
    tags = {"dataset_layer": "gold", "split_strategy": "temporal_holdout"}
    preprocessor = fit_preprocessor(train, features)
    keep = [KEY, LABEL]
    runs, registry, reports, confusion, predicted = [], [], {}, {}, []

    def record(name: str, predictions: DataFrame, run_tags: dict, run_params: dict) -> None:
        predictions.write.mode("overwrite").parquet(f"{out}/{name}/predictions")
        stored_predictions = spark.read.parquet(f"{out}/{name}/predictions")
        metrics = evaluate(stored_predictions)
        runs.append((name, *[metrics.get(k) for k in ("accuracy", "precision", "recall", "f1", "roc_auc")]))
        registry.extend(registry_rows(name, run_tags, run_params, metrics))
        reports[name] = classification_report(stored_predictions, LABEL)
        confusion[name] = confusion_matrix(stored_predictions, LABEL)
        write_json(reports[name], f"{out}/{name}/classification_report")
        write_json(confusion[name], f"{out}/{name}/confusion_matrix")
        predicted.append(stored_predictions.withColumn("model", F.lit(name)))

    with ThreadPoolExecutor(max(1, len(supervised))) as pool:
        # `inheritable_thread_target` gives the threads the caller's job group and other local properties.
        fit = inheritable_thread_target(spark)(models.fit_supervised)
        fits = {name: pool.submit(fit, name, preprocessor, train, LABEL, **options.get(name, {})) for name in supervised}
        contamination = clipped_contamination(train, LABEL)
        forest = fit_isolation_forest(
            preprocessor.transform(train), [KEY], vector_to_array("features"), contamination,
            **options.get("isolation_forest", {}),
        )

        for name, fitted in fits.items():
            model = fitted.result()
            models.save_supervised(spark, f"{out}/{name}", name, model, features)
            record(
                name, models.predict_supervised(model, test, keep),
                {**tags, "problem_type": SUPERVISED_PROBLEM, "label_strategy": "weak_supervision_from_gold_rules"},
                {
                    "model_name": name, **params,
                    "positive_rate_train": facts[True]["rate"] if True in facts else None,
                    "positive_rate_test": facts[False]["rate"] if False in facts else None,
                },
            )

    models.save_unsupervised(spark, f"{out}/isolation_forest", preprocessor, forest, features)
    record(
        "isolation_forest", models.predict_unsupervised(preprocessor, forest, test, keep),
        {**tags, "problem_type": UNSUPERVISED_PROBLEM, "label_strategy": "evaluation_with_weak_labels_only"},
        {"model_name": "isolation_forest", **params, "contamination": contamination},
    )

    summary = rank_models(spark.createDataFrame(runs, RUN_SCHEMA))
    log = spark.createDataFrame(registry, REGISTRY_SCHEMA)
    write_run_summary(summary, f"{out}/run_summary")
    log.coalesce(1).write.mode("overwrite").parquet(f"{out}/run_registry")
    return Experiment(summary, log, reduce(DataFrame.unionByName, predicted), reports, confusion)


__all__ = ["run_experiment", "evaluate", "registry_rows", "confusion_counts", "metrics_from_counts"]
