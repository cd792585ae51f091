import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conftest import rows
from logquarry.learning import forest, models, preprocess
from logquarry.learning.experiment import run_experiment
from logquarry.session import shared_dir
from queries import QUERIES

T0 = dt.datetime(2024, 1, 1)


def feature_rows(spark, n, seed=0, categories=("a", "b")):
    """Two informative columns, one constant, one with gaps, one category; about a tenth are outliers."""
    rng = np.random.default_rng(seed)
    found = []
    for i in range(n):
        odd = rng.random() < 0.1
        x = float(rng.normal(8 if odd else 0))
        found.append(
            (T0 + dt.timedelta(minutes=i), x, float(rng.normal(-8 if odd else 0)), 7, None if i % 5 == 0 else float(i % 11),
             None if i % 9 == 0 else categories[i % len(categories)], int(odd))
        )
    return spark.createDataFrame(
        found, "timestamp timestamp_ntz, x double, y double, constant int, gaps double, kind string, is_anomaly int"
    )


FEATURES = ["x", "y", "constant", "gaps", "kind"]


def test_preprocessor_against_numpy(spark):
    train = feature_rows(spark, 400)
    fitted = preprocess.fit_preprocessor(train, FEATURES)
    found = np.array([r[0] for r in fitted.transform(train).orderBy("timestamp").select(vector_to_array("features")).collect()])
    local = train.orderBy("timestamp").toPandas()
    filled = local[["x", "y", "constant", "gaps"]].astype(float)
    filled = filled.fillna(filled.median())
    deviation = filled.std(ddof=0).replace(0.0, 1.0)
    np.testing.assert_allclose(found[:, :4], ((filled - filled.mean()) / deviation).to_numpy(), atol=1e-9)
    kind = local["kind"].fillna(local["kind"].mode()[0])
    np.testing.assert_array_equal(found[:, 4:], np.stack([kind == "a", kind == "b"], axis=1).astype(float))


def test_unseen_category_and_empty_column(spark):
    train = feature_rows(spark, 50).withColumn("empty", F.lit(None).cast("double"))
    fitted = preprocess.fit_preprocessor(train, [*FEATURES, "empty"])
    other = feature_rows(spark, 10, categories=("zzz",)).withColumn("empty", F.lit(1.0)).where("kind = 'zzz'")
    assert {tuple(r[0][-2:]) for r in fitted.transform(other).select(vector_to_array("features")).collect()} == {(0.0, 0.0)}


def test_modes_are_smallest_on_ties_and_quoted(spark):
    df = spark.createDataFrame([("b'x",), ("b'x",), ("a\\",), ("a\\",), (None,)], "k string")
    assert preprocess.fit_modes(df, ["k"]) == {"k": "a\\"}
    fitted = preprocess.fit_preprocessor(df, ["k"])
    assert fitted.transform(df.where("k IS NULL")).first()["k__filled"] == "a\\"


def test_average_path():
    assert forest.average_path(1) == 0 and forest.average_path(2) == 1
    harmonic = sum(1 / k for k in range(1, 256))
    assert forest.average_path(256) == pytest.approx(2 * harmonic - 2 * 255 / 256, abs=0.01)


@pytest.mark.parametrize("n", [40, 3000])
def test_tree_samples_have_exact_size_and_no_repeats(spark, n):
    df = spark.range(n).select("id", F.array(F.col("id").cast("double")).alias("features"))
    drawn = forest.tree_samples(df, ["id"], F.col("features"), n, trees=30)
    counts = rows(drawn.groupBy("tree").agg(F.count("*"), F.countDistinct(F.col("features")[0])))
    assert sorted(counts) == [(t, min(256, n), min(256, n)) for t in range(30)]
    again = forest.tree_samples(df.repartition(7), ["id"], F.col("features"), n, trees=30)
    assert sorted(rows(drawn)) == sorted(rows(again))


def test_tree_paths_cover_the_sample():
    points = np.random.default_rng(0).normal(size=(200, 3))
    nodes = forest.grow_tree(points, np.random.default_rng(1), 8)
    inner = [n for n in nodes if n[1] >= 0]
    assert len(nodes) == 2 * len(inner) + 1
    assert all(n[5] <= 8 + forest.average_path(200) for n in nodes)
    same = forest.grow_tree(np.ones((50, 2)), np.random.default_rng(1), 8)
    assert same == [(0, -1, 0.0, -1, -1, forest.average_path(50))]


def fitted(spark, df, **options):
    return forest.fit_isolation_forest(df, ["timestamp"], F.array("x", "y"), trees=100, **options)


def test_forest_finds_outliers_at_the_contamination_rate(spark, tmp_path):
    df = feature_rows(spark, 2000).cache()
    grown = fitted(spark, df, contamination=0.1)
    scored = grown.transform(df, F.array("x", "y")).cache()
    assert scored.where("prediction = 1").count() == pytest.approx(200, abs=2)
    assert scored.where("score <= 0 OR score >= 1").count() == 0
    middle = scored.approxQuantile("score", [0.5], 0.0)[0]
    assert scored.where(f"is_anomaly = 1 AND score <= {middle}").count() == 0
    again = fitted(spark, df.repartition(3), contamination=0.1)
    assert again.nodes.equals(grown.nodes) and again.threshold == grown.threshold
    grown.save(spark, str(tmp_path / "forest"))
    loaded = forest.IsolationForest.load(spark, str(tmp_path / "forest"))
    assert sorted(rows(loaded.transform(df, F.array("x", "y")).select("timestamp", "score", "prediction"))) == sorted(
        rows(scored.select("timestamp", "score", "prediction"))
    )


def test_score_of_one_tree_by_hand(spark):
    import pandas as pd

    nodes = pd.DataFrame(
        [(0, 0, 0, 1.5, 1, 2, 0.0), (0, 1, -1, 0.0, -1, -1, 3.0), (0, 2, -1, 0.0, -1, -1, 1.0)], columns=forest.NODE_COLUMNS
    )
    tree = forest.IsolationForest(nodes, 256)
    df = spark.createDataFrame([(1.5,), (1.6,)], "x double")
    scores = [r[0] for r in rows(df.select(tree.score_column(F.array("x"))))]
    assert scores == pytest.approx([2 ** (-3 / forest.average_path(256)), 2 ** (-1 / forest.average_path(256))])


def plain_path(tree, point):
    node = tree[0]
    while node[1] >= 0:
        node = tree[node[3] if point[node[1]] <= node[2] else node[4]]
    return node[5]


def test_rows_walk_down_together_as_alone(spark):
    """Uneven trees, one of a single leaf, and values that are missing or lie on a threshold."""
    import pandas as pd

    rng = np.random.default_rng(3)
    points = np.round(rng.normal(size=(300, 3)), 1)
    points[:40, 1] = np.nan
    samples = [points[40 + 20 * t : 60 + 20 * t] for t in range(6)] + [np.ones((20, 3))]
    trees = [forest.grow_tree(sample, np.random.default_rng(t), 7) for t, sample in enumerate(samples)]
    nodes = pd.DataFrame([(t, *node) for t, tree in enumerate(trees) for node in tree], columns=forest.NODE_COLUMNS)
    grown = forest.IsolationForest(nodes, 20)
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id int, p array<double>")
    got = dict(rows(df.select("id", grown.score_column(F.col("p")))))
    paths = [sum(plain_path(tree, p) for tree in trees) / len(trees) for p in points]
    assert got == {i: pytest.approx(2.0 ** (-path / forest.average_path(20)), abs=1e-15) for i, path in enumerate(paths)}


def test_a_leaf_is_its_own_child():
    feature, left, right = np.array([2, -1, 0, -1, -1]), np.array([1, -1, 3, -1, -1]), np.array([2, -1, 4, -1, -1])
    found, children, steps = forest.walkable(feature, left, right)
    assert found.tolist() == [2, 0, 0, 0, 0] and steps == 2
    assert children.tolist() == [1, 2, 1, 1, 3, 4, 3, 3, 4, 4]
    assert forest.walkable(np.array([-1]), np.array([-1]), np.array([-1]))[2] == 0


def test_sampling_hashes_are_compiled(spark):
    """Every row meets every tree: a lambda would be interpreted for each."""
    df = spark.range(500).select("id", F.array(F.col("id").cast("double")).alias("features"))
    plan = forest.tree_samples(df, ["id"], F.col("features"), 500)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "Generate explode" in plan


def test_contamination_is_clipped(spark):
    df = spark.createDataFrame([(i < 9,) for i in range(10)], "is_anomaly boolean").selectExpr("int(is_anomaly) AS is_anomaly")
    assert forest.clipped_contamination(df) == 0.3
    assert forest.clipped_contamination(df.where("is_anomaly = 0")) == 0.01


def test_balanced_weights(spark):
    weighted, total = models.with_balanced_weight(spark.createDataFrame([(0,)] * 9 + [(1,)], "is_anomaly int"))
    assert total == 10 and dict(rows(weighted.distinct())) == {0: pytest.approx(10 / 18), 1: 5.0}


def test_logistic_regression_reaches_the_penalised_optimum(spark):
    """The gradient of sum(weighted log-loss) + |w|^2 / 2 vanishes at the fitted coefficients."""
    train = feature_rows(spark, 300)
    prepared = preprocess.fit_preprocessor(train, ["x", "gaps"])
    model = models.fit_supervised("logistic_regression", prepared, train).stages[-1]
    local = prepared.transform(train).select(vector_to_array("features"), "is_anomaly").toPandas()
    points, truth = np.stack(local.iloc[:, 0]), local["is_anomaly"].to_numpy()
    weight = np.where(truth == 1, len(truth) / (2 * truth.sum()), len(truth) / (2 * (len(truth) - truth.sum())))
    w, b = model.coefficients.toArray(), model.intercept
    error = weight * (1 / (1 + np.exp(-(points @ w + b))) - truth)
    assert np.abs(points.T @ error + w).max() < 0.05 and abs(error.sum()) < 0.05


OPTIONS = {
    "random_forest": {"trees": 10}, "hist_gradient_boosting": {"rounds": 5}, "isolation_forest": {"trees": 50},
}


def test_experiment_and_saved_models(spark, tmp_path):
    out = str(tmp_path / "run")
    dataset = feature_rows(spark, 500).drop("kind")
    result = run_experiment(spark, dataset, out, options=OPTIONS)
    summary = result.summary.toPandas()
    assert set(summary["model"]) == {"logistic_regression", "random_forest", "hist_gradient_boosting", "isolation_forest"}
    assert list(summary["f1"]) == sorted(summary["f1"], reverse=True) and summary["f1"].min() > 0.5
    assert summary["roc_auc"].min() > 0.95
    assert rows(result.predictions.groupBy("model").count().select("count").distinct()) == [(100,)]
    params = {(r["run"], r["key"]): r["value"] for r in result.registry.where("kind = 'param'").collect()}
    assert params[("random_forest", "train_rows")] == "400" and params[("isolation_forest", "test_rows")] == "100"
    assert params[("random_forest", "n_features")] == "4" and ("isolation_forest", "contamination") in params
    written = spark.read.option("header", True).csv(f"{out}/run_summary")
    assert written.count() == 4 and spark.read.json(f"{out}/random_forest/confusion_matrix").count() == 2
    test = spark.read.parquet(f"{out}/dataset").orderBy(F.desc("timestamp")).limit(100)
    for name in summary["model"]:
        loaded = models.score_dispatch(spark, f"{out}/{name}", test)
        expected = result.predictions.where(F.col("model") == name).select("timestamp", "prediction", "score")
        assert sorted(rows(loaded)) == sorted(rows(expected))
        assert all(math.isfinite(r[2]) for r in rows(loaded))


def test_experiment_fits_models_side_by_side(spark, tmp_path, monkeypatch):
    """All three supervised fits are under way before one ends; what they give is kept in the old order."""
    from threading import Barrier

    together, fit = Barrier(3), models.fit_supervised

    def waiting(*given, **options):
        together.wait(timeout=60)
        return fit(*given, **options)

    monkeypatch.setattr(models, "fit_supervised", waiting)
    done = run_experiment(spark, feature_rows(spark, 500), str(tmp_path / "out"), options=OPTIONS)
    runs = [r["run"] for r in done.registry.where("kind = 'param' AND key = 'n_rows'").collect()]
    assert runs == ["logistic_regression", "random_forest", "hist_gradient_boosting", "isolation_forest"]


def test_boosting_holds_rows_out_only_when_asked(spark):
    train = feature_rows(spark, 400)
    prepared = preprocess.fit_preprocessor(train, ["x", "y"])
    whole = models.fit_supervised("hist_gradient_boosting", prepared, train, rounds=4)
    assert whole.stages[-1].getNumTrees == 4
    model = models.fit_supervised("hist_gradient_boosting", prepared, train, validation_rows=10, rounds=8)
    assert 1 <= model.stages[-1].getNumTrees <= 8
    flags = models.with_validation_flag(train)
    assert 10 <= flags.where("is_validation").count() <= 80


def test_unknown_model(spark):
    train = feature_rows(spark, 20)
    with pytest.raises(ValueError):
        models.fit_supervised("other", preprocess.fit_preprocessor(train, ["x"]), train)


class Fitted(Exception):
    pass


@pytest.mark.parametrize("name", ["logistic_regression", "random_forest", "gradient_boosting", "isolation_forest_score"])
def test_model_queries_fit_minutes_with_the_defaults(spark, sf_dir, monkeypatch, name):
    def seen(*given, **options):
        raise Fitted(given[0 if isinstance(given[0], DataFrame) else 2], options)

    monkeypatch.setattr(models, "fit_supervised", seen)
    monkeypatch.setattr(forest, "fit_isolation_forest", seen)
    with pytest.raises(Fitted) as stopped:
        QUERIES[name](spark, sf_dir)
    train, options = stopped.value.args
    assert options == {} and train.where("minute(timestamp) <> 0").count() > 0
    if name != "isolation_forest_score":
        stored = "hist_gradient_boosting" if name == "gradient_boosting" else name
        assert train.count() == int(0.8 * spark.read.parquet(shared_dir(spark, f"queries/{stored}")).count())


def test_modes_and_many_categories(spark):
    """All modes in one job; a column of more categories than allowed is hashed and does not fail the fit."""
    rows = [(i, f"id{i}", "x" if i % 3 else "y", None, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, many string, few string, empty string, n double")
    assert preprocess.fit_modes(df, ["many", "few", "empty"]) == {"many": "id0", "few": "x"}
    assert preprocess.category_counts(df, ["many", "few", "empty"], 20) == {"many": 21, "few": 2, "empty": 0}
    found = df
    for stage in preprocess.one_hot_stages(df, ["many", "few"], 20):
        found = stage.transform(found)
    for r in found.select("many__hot", "few__hot").collect():
        assert r["many__hot"].size == 20 and r["many__hot"].numNonzeros() == 1 and r["few__hot"].size == 2
