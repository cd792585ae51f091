import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from logquarry.operators import metrics, ranking


def doubles(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")


@pytest.mark.parametrize("probability", [0.0, 0.1, 0.5, 0.77, 0.99, 1.0])
def test_exact_quantiles(spark, probability):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=4001), np.full(2000, 0.25), [np.nan]])
    df = doubles(spark, values.tolist()).withColumn("k", F.col("i") % 7).withColumn("empty", F.lit(None).cast("double"))
    found = ranking.exact_quantiles(df, ["x", "k", "empty"], probability)
    assert set(found) == {"x", "k"}
    assert found["x"] == pytest.approx(np.nanquantile(values, probability), abs=1e-15)
    assert found["k"] == np.quantile(np.arange(len(values)) % 7, probability)


def test_ranks_of_clustered_and_extreme_values(spark):
    """Values that share leading bits, lie at both ends of the doubles, or are the least apart that two can be."""
    near = [1.0]
    for _ in range(200):
        near.append(float(np.nextafter(near[-1], 2.0)))
    values = near + [-v for v in near] + [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf")] + [10.0**-e for e in range(300)]
    df = doubles(spark, values).withColumn("n", F.col("i") * F.lit(2**40) - F.lit(2**48)).withColumn("tiny", (F.col("i") % 100).cast("tinyint"))
    wanted = list(range(0, len(values), 13))
    found = ranking.select_ranks(df, ["x", "n", "tiny"], lambda n: wanted)
    whole = sorted(i * 2**40 - 2**48 for i in range(len(values)))
    assert found["x"] == (len(values), {r: sorted(values)[r] for r in wanted})
    assert found["n"] == (len(values), {r: whole[r] for r in wanted})


def test_ranks_take_few_small_jobs(spark):
    """Repeated values end the search after one pass; counts, not values, are what a window sees."""
    df = doubles(spark, [1.0] * 500 + [2.0] * 3 + [1.0] * 500)
    passes = []
    counts = ranking._bucket_counts
    ranking._bucket_counts = lambda *a: passes.append(a[2]) or counts(*a)
    try:
        assert ranking.exact_quantiles(df, ["x"], 0.9995)["x"] == np.quantile([1.0] * 1000 + [2.0] * 3, 0.9995)
        assert passes == [48]
        passes.clear()
        spread = spark.range(100_000).select((F.col("id") * 7919 % 100_000).cast("double").alias("x"))
        assert ranking.exact_quantiles(spread, ["x"], 0.25)["x"] == 24999.75
        assert len(passes) <= 4
    finally:
        ranking._bucket_counts = counts


@pytest.mark.parametrize("n, train", [(2, 1), (5, 4), (10, 8), (101, 80)])
def test_temporal_split_sizes(spark, n, train):
    times = [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k) for k in random.Random(n).sample(range(10 * n), n)]
    df = spark.createDataFrame([(t,) for t in times], "timestamp timestamp_ntz")
    found = dict(rows(ranking.temporal_split(df)))
    assert {t for t, is_train in found.items() if is_train} == set(sorted(times)[:train])


def test_temporal_split_of_one_row_keeps_it_for_training(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "timestamp timestamp_ntz")
    assert rows(ranking.temporal_split(df))[0][1] is True


def test_rows_without_a_time_come_last(spark):
    times = [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k) for k in range(9)] + [None]
    df = spark.createDataFrame([(t,) for t in times], "timestamp timestamp_ntz")
    found = rows(ranking.temporal_split(df))
    assert {t for t, is_train in found if is_train} == set(times[:8]) and (None, False) in found


def test_temporal_split_with_hot_time(spark):
    """A third of all rows share the time at the cut; the tie-breaker cuts inside them."""
    df = spark.range(3000).select(
        F.col("id"),
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 2400).otherwise(F.col("id"))).cast("timestamp_ntz").alias("timestamp"),
    )
    expected = sorted((2400 if i % 3 == 0 else i, i) for i in range(3000))[:2400]
    found = ranking.temporal_split(df, tie_breakers=["id"]).where("is_train").select("id")
    assert {r[0] for r in rows(found)} == {i for _, i in expected}
    with pytest.raises(ValueError):
        ranking.temporal_split(df)


def test_last_n_and_top_k(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("g"), "id")
    assert sorted(rows(ranking.last_n_rows(df, ["id"], 3))) == [(7, 97), (8, 98), (9, 99)]
    top = ranking.topk_per_group(df, ["g"], ["id"], 2)
    assert top.count() == 20 and {r[2] for r in rows(top.where("id < 10"))} == {1}


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_running_totals(spark, buckets):
    values = random.Random(3).sample(range(10_000), 500)
    df = spark.createDataFrame([(float(v), v % 5) for v in values], "x double, w bigint")
    found = {r["x"]: r["below"] for r in ranking.with_running_totals(df, "x", {"below": "w"}, buckets).collect()}
    assert found == {float(v): sum(u % 5 for u in values if u < v) for v in values}


def brute_auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [1, 4, 1000])
def test_auc_against_all_pairs(spark, levels):
    rng = random.Random(levels)
    pairs = [(int(rng.random() < 0.3), float(rng.randrange(levels))) for _ in range(400)]
    df = spark.createDataFrame(pairs, "label int, score double")
    assert rows(metrics.roc_auc(df))[0][0] == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_is_missing_for_one_class(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.2)], "label int, score double")
    assert rows(metrics.roc_auc(df)) == [(None,)]


# Published results of one training run: confusion cells (tn, fp, fn, tp) and accuracy, precision, recall, F1.
GOLDEN = {
    "random_forest": ((19037, 0, 0, 148), (1.0, 1.0, 1.0, 1.0)),
    "logistic_regression": (
        (19023, 14, 0, 148), (0.999270263226479, 0.9135802469135802, 1.0, 0.9548387096774194),
    ),
    "hist_gradient_boosting": (
        (19030, 7, 8, 140), (0.9992181391712275, 0.9523809523809523, 0.9459459459459459, 0.9491525423728814),
    ),
    "isolation_forest": (
        (18420, 617, 3, 145), (0.9676830857440709, 0.19028871391076116, 0.9797297297297297, 0.31868131868131866),
    ),
}


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_golden_metrics(spark, name):
    cells, expected = GOLDEN[name]
    counts = spark.createDataFrame([cells], "tn bigint, fp bigint, fn bigint, tp bigint")
    assert rows(metrics.metrics_from_counts(counts))[0] == pytest.approx(expected, abs=1e-15)
    report = {r["class"]: r for r in metrics.report_from_counts(counts).collect()}
    assert report["accuracy"]["f1_score"] == pytest.approx(expected[0], abs=1e-15)
    assert report["1"]["support"] == 148.0 and report["0"]["support"] == 19037.0
    assert report["macro avg"]["recall"] == pytest.approx(
        (report["0"]["recall"] + report["1"]["recall"]) / 2, abs=1e-15
    )
    assert report["weighted avg"]["recall"] == pytest.approx(expected[0], abs=1e-12)


def test_report_without_positive_predictions_or_second_class(spark):
    none = spark.createDataFrame([(5, 0, 2, 0)], "tn bigint, fp bigint, fn bigint, tp bigint")
    report = {r["class"]: r for r in metrics.report_from_counts(none).collect()}
    assert (report["1"]["precision"], report["1"]["recall"], report["1"]["f1_score"]) == (0.0, 0.0, 0.0)
    single = spark.createDataFrame([(7, 0, 0, 0)], "tn bigint, fp bigint, fn bigint, tp bigint")
    report = {r["class"]: r for r in metrics.report_from_counts(single).collect()}
    assert set(report) == {"0", "accuracy", "macro avg", "weighted avg"}
    assert report["macro avg"]["f1_score"] == 1.0
    assert rows(metrics.metrics_from_counts(none))[0][1:] == (0.0, 0.0, 0.0)


def test_confusion_matrix_rows_are_the_truth(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (1, 1), (0, 0)], "label int, prediction int")
    assert sorted(rows(metrics.confusion_matrix(df))) == [(0, 1, 2), (1, 1, 1)]
