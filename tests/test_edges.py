"""Behaviour at the edges: missing cells, large numbers, time formats, shared folders, calls of an embedding hook."""

import pytest
from logquarry import session
from logquarry.functions.columns import float_text, parse_utc
from logquarry.operators import metrics, textify, vectors
from logquarry.plans import answering
from pyspark.sql import functions as F


def test_large_numbers_read_as_usual(spark):
    values = [9999999.5, 1e7, 12345678.9, 123456789012345.0, -2.5e9, 1e16, 2.5e20, 4e-06, 0.0005, 0.0]
    found = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(float_text(F.col("x"))).collect()]
    assert found == [repr(v) for v in values]


def test_a_missing_cell_keeps_its_sentence(spark):
    row = spark.createDataFrame([(None, None, None, None, 3, None)], "timestamp timestamp, date date, hora_completa string, service string, requests long, cost double")
    assert "nan" in textify.textify_rows(row, "cost").first()["text"]


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_a_missing_score_is_an_error(spark, bad):
    scores = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, bad)], "label int, score double")
    with pytest.raises(Exception, match="missing scores"):
        metrics.roc_auc(scores).collect()


def test_several_time_formats(spark):
    texts = spark.createDataFrame([("2024-02-01T10:00:00Z",), ("01/02/2024 10:00",), ("Feb 1",), (None,)], "x string")
    found = [r[0] for r in texts.select(parse_utc(F.col("x"), ["", "dd/MM/yyyy HH:mm"])).collect()]
    assert found[0] == found[1] and found[0].hour == 10 and found[2:] == [None, None]


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(), "x")


def test_each_question_is_embedded_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def embed(texts):
        calls.add(len(texts))
        return [[float(len(t)), 1.0] for t in texts]

    corpus = spark.createDataFrame([(i, "cost", f"text {i}", [float(i), 1.0]) for i in range(9)], "id long, domain string, text string, embedding array<float>")
    questions = spark.createDataFrame([(i, f"Qual e o custo {i}?") for i in range(20)], "question_id long, question string")
    answered = answering.batch_retrieve(questions, corpus, {}, embed=embed, dim=2)
    assert answered.count() == 20
    answered.collect()
    assert calls.value == 20
