"""Supervised models, prediction, and saving with metadata."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.fixed_values import SEED, SUPERVISED_PROBLEM, UNSUPERVISED_PROBLEM
from logquarry.learning.forest import IsolationForest
from logquarry.operators.features import KEY


def with_balanced_weight(train: DataFrame, label: str = "is_anomaly") -> tuple[DataFrame, float]:
    """Add `weight` = n / (classes * rows of the class); also the sum of weights, which is n."""
    counts = {row[0]: row[1] for row in train.groupBy(label).count().collect()}
    n = sum(counts.values())
    weight = F.lit(1.0)
    for value, rows in counts.items():
        weight = F.when(F.col(label) == value, n / (len(counts) * rows)).otherwise(weight)
    return train.withColumn("weight", weight), float(n)


def logistic_regression(total_weight: float, label: str = "is_anomaly", max_iter: int = 1000, c: float = 1.0):
    """L2 strength c on the summed loss: Spark averages the loss, so the penalty is 1 / (c * total weight)."""
    return LogisticRegression(
        featuresCol="features", labelCol=label, weightCol="weight", maxIter=max_iter,
        regParam=1.0 / (c * total_weight), elasticNetParam=0.0, standardization=False,
    )


def random_forest(label: str = "is_anomaly", trees: int = 300, depth: int = 10, seed: int = SEED):
    return RandomForestClassifier(
        featuresCol="features", labelCol=label, weightCol="weight", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=2, featureSubsetStrategy="sqrt", maxBins=255, seed=seed,
    )


def gradient_boosting(
    label: str = "is_anomaly", rounds: int = 200, depth: int = 6, rate: float = 0.05, seed: int = SEED,
    validation: str | None = None,
):
    """Histogram boosting on 255 bins with at least 20 rows per leaf; trees are bounded by depth only."""
    model = GBTClassifier(
        featuresCol="features", labelCol=label, stepSize=rate, maxDepth=depth, maxIter=rounds, maxBins=255,
        minInstancesPerNode=20, seed=seed,
    )
    if validation:
        model = model.setValidationIndicatorCol(validation)
        model = model.setParams(validationTol=0.0)
    return model


def with_validation_flag(train: DataFrame, key: str = KEY, share: int = 10, seed: int = SEED) -> DataFrame:
    """Mark one row in `share` for early stopping, by hash of its key."""
    return train.withColumn("is_validation", F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(share)) == 0)


def fit_supervised(
    name: str, preprocessor: PipelineModel, train: DataFrame, label: str = "is_anomaly",
    validation_rows: int | None = None, **options,
) -> PipelineModel:
    """Fit one of logistic_regression, random_forest, hist_gradient_boosting on preprocessed rows.

    With `validation_rows` boosting holds one row in so many out and stops when these no longer improve; without, it
    trains on all rows for all rounds, whatever their number.
    """
    prepared = preprocessor.transform(train)
    if name == "hist_gradient_boosting":
        validation = "is_validation" if validation_rows else None
        prepared = with_validation_flag(prepared, share=validation_rows) if validation else prepared
        estimator = gradient_boosting(label, validation=validation, **options)
        columns = ["features", label] + ([validation] if validation else [])
    else:
        prepared, total = with_balanced_weight(prepared, label)
        columns = ["features", label, "weight"]
        if name == "logistic_regression":
            estimator = logistic_regression(total, label, **options)
        elif name == "random_forest":
            estimator = random_forest(label, **options)
        else:
            raise ValueError(f"Unknown model {name}")
    model = estimator.fit(prepared.select(*columns))
    return PipelineModel([*preprocessor.stages, model])


def predict_supervised(model: Transformer, features: DataFrame, keep=(KEY,)) -> DataFrame:
    """(keep, prediction, score): the class and the probability of class 1; of a model without probabilities its decision
    value for class 1, and without that either the class."""
    scored = model.transform(features)
    known = next((c for c in ("probability", "rawPrediction") if c in scored.columns), None)
    score = vector_to_array(known)[1] if known else F.col("prediction").cast("double")
    return scored.select(*keep, F.col("prediction").cast("int").alias("prediction"), score.alias("score"))


def predict_unsupervised(
    preprocessor: PipelineModel, forest: IsolationForest, features: DataFrame, keep=(KEY,)
) -> DataFrame:
    prepared = preprocessor.transform(features)
    scored = forest.transform(prepared, vector_to_array("features"))
    return scored.select(*keep, "prediction", "score")


def write_metadata(spark: SparkSession, path: str, facts: dict) -> None:
    spark.createDataFrame([(json.dumps(facts, ensure_ascii=False),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/metadata")


def read_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/metadata").first()[0])


def save_supervised(
    spark: SparkSession, path: str, name: str, model: PipelineModel, features: list[str], target: str = "is_anomaly"
) -> None:
    model.write().overwrite().save(f"{path}/model")
    write_metadata(
        spark, path,
        {"model_name": name, "feature_columns": features, "target": target, "problem_type": SUPERVISED_PROBLEM},
    )


def save_unsupervised(
    spark: SparkSession, path: str, preprocessor: PipelineModel, forest: IsolationForest, features: list[str],
    target: str = "is_anomaly",
) -> None:
    preprocessor.write().overwrite().save(f"{path}/preprocessor")
    forest.save(spark, f"{path}/forest")
    write_metadata(
        spark, path,
        {
            "model_name": "isolation_forest", "feature_columns": features, "target": target,
            "problem_type": UNSUPERVISED_PROBLEM,
        },
    )


def score_dispatch(spark: SparkSession, path: str, features: DataFrame, keep=(KEY,)) -> DataFrame:
    """Load whatever model was saved at `path` and score the feature table with it."""
    facts = read_metadata(spark, path)
    features = features.select(*keep, *[f"`{c}`" for c in facts["feature_columns"]])
    if facts["problem_type"] == UNSUPERVISED_PROBLEM:
        preprocessor = PipelineModel.load(f"{path}/preprocessor")
        return predict_unsupervised(preprocessor, IsolationForest.load(spark, f"{path}/forest"), features, keep)
    return predict_supervised(PipelineModel.load(f"{path}/model"), features, keep)
