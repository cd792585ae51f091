"""Preprocessing, models, forest and experiment on the feature table by minute, with the operators' defaults."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.fixed_values import SERVICES
from logquarry.learning import forest, models, preprocess
from logquarry.learning.experiment import RUN_SCHEMA, run_experiment
from logquarry.operators import labels, ranking
from logquarry.session import shared_dir
from queries.aggregates import features_sql
from queries.inputs import RAW_LOGS, marts, raw_logs, table
from queries.registry import query

KEY, LABEL = "timestamp", "is_anomaly"


def dataset(spark, sf, grain="minute"):
    made = marts(spark, sf, grain)
    return labels.modeling_dataset(made["cost"], made["performance"], made["security"], SERVICES)


def stored_dataset(spark, sf, name: str, grain="minute"):
    """The modelling table written once to the shared folder: model fits read their input many times."""
    path = shared_dir(spark, f"queries/{name}")
    dataset(spark, sf, grain).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def feature_names(df):
    return [c for c in df.columns if c not in (KEY, LABEL)]


ORDERS_WITH_GAPS = """gaps AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS customer FROM orders)"""


def orders_with_gaps(spark, sf):
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.when(key % 7 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 5 != 0, F.col("o_custkey")).alias("customer"),
    )


@query(
    "impute_median",
    f"""WITH {ORDERS_WITH_GAPS} SELECT o_orderkey, round(coalesce(price, (SELECT median(price) FROM gaps)), 6) AS price,
        CAST(coalesce(customer, (SELECT median(customer) FROM gaps)) AS DOUBLE) AS customer FROM gaps""",
)
def _(spark, sf):
    gaps = orders_with_gaps(spark, sf)
    imputed = preprocess.impute_median(gaps, preprocess.fit_medians(gaps, ["price", "customer"]))
    return imputed.withColumn("price", F.round("price", 6))


@query(
    "standard_scale",
    """SELECT event_id, round((value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events), 6) + 0.0
       AS value FROM events""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    scaled = preprocess.standard_scale(events, preprocess.fit_scales(events, ["value"]))
    return scaled.withColumn("value", F.round("value", 6) + F.lit(0.0))


@query(
    "impute_mode",
    f"""WITH {RAW_LOGS} SELECT eventtime, coalesce(eventname, (SELECT eventname FROM raw_logs WHERE eventname IS NOT NULL
        GROUP BY eventname ORDER BY count(*) DESC, eventname LIMIT 1)) AS eventname FROM raw_logs""",
)
def _(spark, sf):
    raw = raw_logs(spark, sf).select("eventtime", "eventname")
    return preprocess.impute_mode(raw, preprocess.fit_modes(raw, ["eventname"]))


@query(
    "one_hot",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END::DOUBLE AS c0,
       CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END::DOUBLE AS c1,
       CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END::DOUBLE AS c2 FROM events""",
)
def _(spark, sf):
    """Fitted on three of the five types: the other two are coded as all zeros."""
    events = table(spark, sf, "events").select("event_id", "event_type")
    stages = preprocess.one_hot_stages(events.where("event_type IN ('click', 'error', 'purchase')"), ["event_type"])
    for stage in stages:
        events = stage.transform(events)
    slots = vector_to_array("event_type__hot")
    return events.select("event_id", *[slots[i].alias(f"c{i}") for i in range(3)])


NUMERIC = [
    "total_cost", "total_requests_cost", "requests_service_ec2", "requests_service_iam", "requests_service_other_services",
    "requests_service_s3", "cost_service_ec2", "cost_service_iam", "cost_service_other_services", "cost_service_s3",
    "total_requests_perf", "total_unique_users", "total_requests_security", "year", "month", "day", "hour", "day_of_week",
    "is_weekend", "hour_sin", "hour_cos", "avg_cost_per_request", "security_to_perf_ratio",
]


# The feature text above rounds these two for its own comparison; scaling starts from the full value.
FULL = {"hour_sin": "sin(2 * pi() * hour / 24)", "hour_cos": "cos(2 * pi() * hour / 24)"}


def _scaled(name: str) -> str:
    x = f"CAST({FULL.get(name, name)} AS DOUBLE)"
    spread = f"(SELECT CASE WHEN stddev_pop({x}) <= 1e-12 * abs(avg({x})) THEN 1 ELSE stddev_pop({x}) END FROM features)"
    return f"round(({x} - (SELECT avg({x}) FROM features)) / {spread}, 5) + 0.0 AS {name}"


@query(
    "preprocessor",
    f"""WITH {features_sql('minute')} SELECT "timestamp", {', '.join(map(_scaled, NUMERIC))} FROM features""",
)
def _(spark, sf):
    rows = stored_dataset(spark, sf, "preprocessor")
    fitted = preprocess.fit_preprocessor(rows, NUMERIC)
    vector = vector_to_array("features")
    scaled = [(F.round(vector[i], 5) + F.lit(0.0)).alias(name) for i, name in enumerate(NUMERIC)]
    return fitted.transform(rows).select(KEY, *scaled)


def _supervised(name):
    def build(spark, sf):
        """Trained on the older rows; all are scored, `is_train` tells which the model has seen."""
        rows = ranking.temporal_split(stored_dataset(spark, sf, name), KEY)
        train = rows.where("is_train").drop("is_train")
        fitted = preprocess.fit_preprocessor(train, feature_names(train))
        model = models.fit_supervised(name, fitted, train, LABEL)
        return models.predict_supervised(model, rows, (KEY, "is_train"))

    return build


query("logistic_regression")(_supervised("logistic_regression"))
query("random_forest")(_supervised("random_forest"))
query("gradient_boosting")(_supervised("hist_gradient_boosting"))


@query("predict_supervised")
def _(spark, sf):
    """Trained on the older rows, scored on the newer ones."""
    rows = ranking.temporal_split(stored_dataset(spark, sf, "predict_supervised"), KEY)
    train, test = rows.where("is_train").drop("is_train"), rows.where("NOT is_train").drop("is_train")
    model = models.fit_supervised(
        "logistic_regression", preprocess.fit_preprocessor(train, feature_names(train)), train, LABEL
    )
    return models.predict_supervised(model, test)


@query("save_load_model", f"""WITH {features_sql('minute')} SELECT "timestamp", true AS same FROM features""")
def _(spark, sf):
    """A saved and loaded model gives the predictions of the fitted one."""
    rows = stored_dataset(spark, sf, "save_load_model")
    fitted = preprocess.fit_preprocessor(rows, feature_names(rows))
    model = models.fit_supervised("logistic_regression", fitted, rows, LABEL)
    path = shared_dir(spark, "queries/save_load_model_files")
    models.save_supervised(spark, path, "logistic_regression", model, feature_names(rows))
    before = models.predict_supervised(model, rows).select(KEY, F.struct("prediction", "score").alias("before"))
    after = models.score_dispatch(spark, path, rows).select(KEY, F.struct("prediction", "score").alias("after"))
    return before.join(after, KEY).select(KEY, (F.col("before") == F.col("after")).alias("same"))


def fitted_forest(spark, sf, name):
    rows = stored_dataset(spark, sf, name)
    fitted = preprocess.fit_preprocessor(rows, feature_names(rows))
    grown = forest.fit_isolation_forest(
        fitted.transform(rows), [KEY], vector_to_array("features"), forest.clipped_contamination(rows),
    )
    return rows, fitted, grown


@query("isolation_forest_fit")
def _(spark, sf):
    """The node table of the fitted trees."""
    _, _, grown = fitted_forest(spark, sf, "isolation_forest_fit")
    return spark.createDataFrame(grown.nodes, forest.NODE_SCHEMA)


@query("isolation_forest_score")
def _(spark, sf):
    rows, fitted, grown = fitted_forest(spark, sf, "isolation_forest_score")
    return models.predict_unsupervised(fitted, grown, rows)


@query("score_dispatch")
def _(spark, sf):
    """Both kinds of model saved, loaded by their metadata and used on the same rows."""
    rows, fitted, grown = fitted_forest(spark, sf, "score_dispatch")
    names = feature_names(rows)
    base = shared_dir(spark, "queries/score_dispatch_models")
    models.save_unsupervised(spark, f"{base}/isolation_forest", fitted, grown, names)
    model = models.fit_supervised("logistic_regression", fitted, rows, LABEL)
    models.save_supervised(spark, f"{base}/logistic_regression", "logistic_regression", model, names)
    parts = [
        models.score_dispatch(spark, f"{base}/{name}", rows).withColumn("model", F.lit(name))
        for name in ("isolation_forest", "logistic_regression")
    ]
    return parts[0].unionByName(parts[1])


_EXPERIMENTS: dict[tuple[str, str], str] = {}


def _experiment(spark, sf):
    """The folder of a whole experiment over one table, run once per application."""
    name = (spark.sparkContext.applicationId, sf)
    if name not in _EXPERIMENTS:
        out = shared_dir(spark, f"queries/experiment-{uuid4().hex}")
        run_experiment(spark, dataset(spark, sf), out)
        _EXPERIMENTS[name] = out
    return _EXPERIMENTS[name]


def read_run_summary(spark, out):
    return spark.read.schema(RUN_SCHEMA).option("header", True).csv(f"{out}/run_summary")


MODELS = ("hist_gradient_boosting", "isolation_forest", "logistic_regression", "random_forest")


@query("experiment")
def _(spark, sf):
    return read_run_summary(spark, _experiment(spark, sf))


@query("run_registry")
def _(spark, sf):
    return spark.read.parquet(f"{_experiment(spark, sf)}/run_registry")


LABELLED = f"""WITH {features_sql('minute')},
flags AS (SELECT "timestamp", max(CASE WHEN risk_level = 'alto' THEN 1 ELSE 0 END) AS is_anomaly FROM security GROUP BY "timestamp"),
labelled AS (SELECT "timestamp", coalesce(is_anomaly, 0) AS is_anomaly, row_number() OVER (ORDER BY "timestamp") AS place, count(*) OVER () AS n
  FROM features LEFT JOIN flags USING ("timestamp")),
divided AS (SELECT *, place <= greatest(1, least(CAST(floor(n * 0.8::DOUBLE) AS BIGINT), n - 1)) AS is_train FROM labelled),
models(model) AS (VALUES {', '.join(f"('{m}')" for m in MODELS)})"""


@query(
    "experiment_facts",
    f"""{LABELLED}, facts AS (
      SELECT max(n) AS n_rows, count(*) FILTER (is_train) AS train_rows, count(*) FILTER (NOT is_train) AS test_rows,
             avg(is_anomaly) FILTER (is_train) AS train_rate, avg(is_anomaly) FILTER (NOT is_train) AS test_rate FROM divided)
    SELECT model, CAST(n_rows AS BIGINT) AS n_rows, CAST(train_rows AS BIGINT) AS train_rows, CAST(test_rows AS BIGINT) AS test_rows, {len(NUMERIC)}::BIGINT AS n_features,
      round(CASE WHEN model = 'isolation_forest' THEN NULL ELSE train_rate END, 10) AS train_rate,
      round(CASE WHEN model = 'isolation_forest' THEN NULL ELSE test_rate END, 10) AS test_rate,
      round(CASE WHEN model = 'isolation_forest' THEN least(greatest(train_rate, {forest.CONTAMINATION_RANGE[0]}), {forest.CONTAMINATION_RANGE[1]}) END, 10) AS contamination
    FROM models CROSS JOIN facts""",
)
def _(spark, sf):
    """What the registry says about the split, the labels and the forest's contamination."""
    rows = spark.read.parquet(f"{_experiment(spark, sf)}/run_registry").where("kind = 'param'").groupBy(F.col("run").alias("model"))

    def fact(key, kind):
        return F.max(F.when(F.col("key") == key, F.col("value").cast(kind)))

    counts = [fact(k, "bigint").alias(k) for k in ("n_rows", "train_rows", "test_rows", "n_features")]
    rates = {"train_rate": "positive_rate_train", "test_rate": "positive_rate_test", "contamination": "contamination"}
    return rows.agg(*counts, *[F.round(fact(k, "double"), 10).alias(name) for name, k in rates.items()])


@query(
    "experiment_predictions",
    f"""{LABELLED} SELECT model, "timestamp", is_anomaly, true AS score_is_share, true AS prediction_follows_score
    FROM models CROSS JOIN divided WHERE NOT is_train""",
)
def _(spark, sf):
    """Every model scores each newer minute once, and predicts what its score and threshold say."""
    out, found = _experiment(spark, sf), []
    for name in MODELS:
        limit = 0.5
        if name == "isolation_forest":
            limit = forest.IsolationForest.load(spark, f"{out}/{name}/forest").threshold
        rows = spark.read.parquet(f"{out}/{name}/predictions")
        follows = (F.col("score") > limit).cast("int") == F.col("prediction")
        share = F.col("score").between(0.0, 1.0)
        found.append(rows.select(F.lit(name).alias("model"), KEY, F.col(LABEL).cast("int").alias(LABEL), share.alias("score_is_share"), follows.alias("prediction_follows_score")))
    return reduce(DataFrame.unionByName, found)


@query("experiment_metrics", f"WITH models(model) AS (VALUES {', '.join(f'({m!r})' for m in MODELS)}) SELECT model, true AS same FROM models")
def _(spark, sf):
    """The summary's numbers against plain counts over the stored predictions."""
    out, found = _experiment(spark, sf), []
    summary = {r["model"]: r for r in read_run_summary(spark, out).collect()}  # one row per model
    for name in MODELS:
        rows = spark.read.parquet(f"{out}/{name}/predictions")
        true, said = F.col(LABEL) == 1, F.col("prediction") == 1
        cells = {"tp": true & said, "fp": ~true & said, "fn": true & ~said, "tn": ~true & ~said}
        counts = rows.agg(*[F.count(F.when(c, 1)).alias(k) for k, c in cells.items()])
        counts = counts.withColumn("p", F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0))
        counts = counts.withColumn("r", F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0))
        accuracy = (F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
        f1 = F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0)
        numbers = {"accuracy": accuracy, "precision": F.col("p"), "recall": F.col("r"), "f1": f1}
        same = [F.abs(value - F.lit(float(summary[name][k]))) < 1e-9 for k, value in numbers.items()]
        found.append(counts.select(F.lit(name).alias("model"), reduce(lambda a, b: a & b, same).alias("same")))
    return reduce(DataFrame.unionByName, found)


@query("logistic_regression_optimum", f"SELECT unnest([{', '.join(repr(c) for c in ['intercept', *NUMERIC])}]) AS term, true AS stationary")
def _(spark, sf):
    """At the optimum the gradient of the penalised, weighted loss is nothing in every term."""
    out = _experiment(spark, sf)
    rows = ranking.temporal_split(spark.read.parquet(f"{out}/dataset"), KEY).where("is_train").drop("is_train")
    model = PipelineModel.load(f"{out}/logistic_regression/model")
    weighted, total = models.with_balanced_weight(rows, LABEL)
    scored = model.transform(weighted)
    gap = F.col("weight") * (vector_to_array("probability")[1] - F.col(LABEL))
    names = feature_names(rows)
    inputs = vector_to_array("features")
    sums = scored.agg(F.sum(gap).alias("intercept"), *[F.sum(gap * inputs[i]).alias(c) for i, c in enumerate(names)]).first()
    fitted = model.stages[-1]
    # The penalty's share of the gradient: the coefficient itself, as its strength is 1 on the summed loss.
    slopes = {"intercept": sums["intercept"], **{c: sums[c] + float(fitted.coefficients[i]) for i, c in enumerate(names)}}
    return spark.createDataFrame([(c, abs(v) <= 1e-3 * total) for c, v in slopes.items()], "term string, stationary boolean")


@query(
    "score_dispatch_same",
    f"{LABELLED} SELECT model, count(*) AS n, true AS same FROM models CROSS JOIN labelled WHERE model IN ('isolation_forest', 'logistic_regression') GROUP BY model",
)
def _(spark, sf):
    """Models found by their metadata give what the same models give directly."""
    out, found = _experiment(spark, sf), []
    rows = spark.read.parquet(f"{out}/dataset")
    for name in ("isolation_forest", "logistic_regression"):
        if name == "isolation_forest":
            grown = forest.IsolationForest.load(spark, f"{out}/{name}/forest")
            direct = models.predict_unsupervised(PipelineModel.load(f"{out}/{name}/preprocessor"), grown, rows)
        else:
            direct = models.predict_supervised(PipelineModel.load(f"{out}/{name}/model"), rows)
        sent = models.score_dispatch(spark, f"{out}/{name}", rows).select(KEY, F.struct("prediction", "score").alias("sent"))
        both = direct.select(KEY, F.struct("prediction", "score").alias("direct")).join(sent, KEY)
        found.append(both.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("sent") == F.col("direct")).alias("same")).select(F.lit(name).alias("model"), "n", "same"))
    return reduce(DataFrame.unionByName, found)
