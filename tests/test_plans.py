"""What the physical plans must look like, whatever the size of the data."""

import re

import pytest
from pyspark.sql import functions as F

from logquarry.operators import cells, marts, ranking, vectors
from logquarry.plans.silver import clean_logs
from queries import QUERIES
from queries.inputs import corpus, question_vectors

# Queries whose models are fitted while they are built; their plans are those of Spark ML.
FITTED = {
    "experiment", "run_registry", "score_dispatch", "random_forest", "gradient_boosting", "logistic_regression",
    "isolation_forest_fit", "isolation_forest_score", "predict_supervised", "save_load_model", "preprocessor",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "raw")
    spark.range(1000).select(
        F.date_format(F.timestamp_seconds("id"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventtime"),
        F.lit("RunInstances").alias("eventname"), F.col("id").cast("string").alias("useridentityaccountid"),
        F.lit("1.2.3.4").alias("sourceipaddress"), F.lit("{}").alias("requestparameters"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def cleaned(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "cleaned")
    clean_logs(raw).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_query_pairs_all_rows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_cleaning_shuffles_once_and_filters_first(raw):
    text = plan(clean_logs(raw))
    assert text.count("Exchange ") == 1 and "Python" not in text
    below = text[text.index("Exchange ") :]
    assert "isnotnull(eventname" in below and "cast(eventtime" in below
    assert "PushedFilters: [IsNotNull(eventname)" in text or "IsNotNull(eventname)" in text.split("PushedFilters")[1]


@pytest.mark.parametrize(
    "build, columns",
    [
        (marts.mart_cost, ["timestamp", "event"]),
        (marts.mart_performance, ["timestamp", "user_hash"]),
        (marts.mart_security, ["timestamp", "user_hash"]),
    ],
)
def test_marts_read_only_their_columns(cleaned, build, columns):
    text = plan(build(marts.prepare_events(cleaned)))
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {part.split(":")[0] for part in schema.split(",")} == set(columns)
    assert "IsNotNull(timestamp)" in text and "Python" not in text
    assert "partial_count(1)" in text


def test_top_k_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    text = plan(ranking.topk_per_group(df, ["g"], ["id"], 5))
    assert text.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(ranking.last_n_rows(df, ["id"], 5))


def test_questions_leave_the_corpus_where_it_is(spark, sf_dir):
    """No join, no shuffle, no constant key: one pass over the corpus, and only the asked domain of it."""
    texts, questions = corpus(spark, sf_dir).select("id", "domain", "embedding"), question_vectors(spark, sf_dir)
    asked = questions.withColumns({"domain": F.lit("cost"), "n": F.lit(5)})
    before = plan(texts)
    for found in (vectors.knn_candidates(texts, asked, "domain"), vectors.knn_candidates(texts, asked)):
        text = plan(found)
        assert text.count("MapInArrow") == 1
        for node in ("Join", "Exchange", "Sort"):
            assert text.count(node) <= before.count(node)


def test_index_reads_only_probed_folders(spark, sf_dir, tmp_path):
    texts, questions = corpus(spark, sf_dir).select("id", "domain", "embedding"), question_vectors(spark, sf_dir)
    cells.build_index(texts, str(tmp_path / "index"), cells=9)
    index = cells.open_index(spark, str(tmp_path / "index"))
    one = questions.orderBy("question_id").limit(1)
    probed = {r["cell"] for r in cells.probed_cells(index, one, 2).collect()}
    candidates = vectors.knn_candidates(index.rows, cells.probed_cells(index, one, 2).withColumn("n", F.lit(5)), "cell")
    text = plan(candidates)
    assert "PartitionFilters: [cell" in text and "Exchange" not in text
    assert candidates.count() and 0 < len(probed) <= 2
    named = re.search(r"PartitionFilters: \[cell#\d+ IN \(([\d,]+)\)", text) or re.search(r"\(cell#\d+ = (\d+)\)", text)
    assert {int(c) for c in named[1].split(",")} == probed


def test_zscore_is_a_subquery_not_a_join(spark):
    text = plan(marts.global_zscore(spark.range(10), "id"))
    assert "Subquery" in text and "Join" not in text and "Window" not in text
