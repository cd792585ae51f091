"""Stored marts to models, and saved models to predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logquarry.learning.experiment import Experiment, run_experiment
from logquarry.learning.models import read_metadata, score_dispatch
from logquarry.operators.features import feature_store
from logquarry.operators.labels import modeling_dataset
from logquarry.sources.logs import MART_SCHEMAS
from logquarry.sources.sinks import write_predictions
from logquarry.sources.snapshots import first_available_source, matching_paths, read_expected_or_last_day

DOMAINS = ["cost", "performance", "security"]
PREFIX = "requests_service_"


def load_mart(spark: SparkSession, domain: str, bases: list[str]) -> DataFrame:
    """Newest day of a mart from the first base that has it: a table partitioned by `dt`, or one file per day."""
    for base in bases:
        if matching_paths(spark, f"{base}/{domain}/dt=*/part-*.parquet"):
            return read_expected_or_last_day(spark, f"{base}/{domain}")
    return first_available_source(spark, domain, domain, bases, MART_SCHEMAS[domain])


def train_from_marts(spark: SparkSession, bases: list[str], out: str, **options) -> Experiment:
    cost, performance, security = (load_mart(spark, domain, bases) for domain in DOMAINS)
    return run_experiment(spark, modeling_dataset(cost, performance, security), out, **options)


def predict_from_marts(spark: SparkSession, bases: list[str], model_path: str, out: str) -> DataFrame:
    """Score every minute of the newest marts with a saved model and write (timestamp, prediction, score).

    The services are those the model was trained on, whichever of them occur now.
    """
    cost, performance, security = (load_mart(spark, domain, bases) for domain in DOMAINS)
    trained_on = read_metadata(spark, model_path)["feature_columns"]
    services = [c.removeprefix(PREFIX) for c in trained_on if c.startswith(PREFIX)]
    predictions = score_dispatch(spark, model_path, feature_store(cost, performance, security, services))
    write_predictions(predictions, out)
    return predictions
