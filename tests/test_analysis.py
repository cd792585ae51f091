"""As-of joins, rollups, JSON fields, incremental corpus and counted writes against brute force and on edge tables."""

import random

import pytest
from pyspark.ml import Transformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import rows
from logquarry.functions import json_fields
from logquarry.learning.models import predict_supervised
from logquarry.operators import asof, rollups
from logquarry.plans import corpus
from logquarry.sources import sinks
from logquarry.sources.logs import scan_auto


@pytest.mark.parametrize("ranges, strict", [(1, False), (4, True), (16, False), (64, True)])
def test_as_of_join_against_all_pairs(spark, ranges, strict):
    """A hot key, a hot moment, ties, nulls, repeated rows and columns of equal names."""
    rng = random.Random(ranges)
    key = lambda: rng.choice([7, 7, 7, 1, 2, 9, None])
    time = lambda: rng.choice([50, 50, rng.randrange(100), None])
    left = [(i % 200, key(), time(), "left") for i in range(300)]
    right = [(i, key(), time(), rng.choice([None, "a", "b"])) for i in range(150)]
    columns = "i long, k int, t long, k0 string"
    found = asof.as_of_join(
        spark.createDataFrame(left, columns).repartition(3), spark.createDataFrame(right, columns).repartition(5), ["k"], "t", "last", strict, ranges
    )

    def match(row):
        fits = [r for r in right if None not in (row[1], row[2], r[2]) and r[1] == row[1] and (r[2] < row[2] or (not strict and r[2] == row[2]))]
        return max(fits, key=lambda r: (r[2], r[0]), default=None)

    assert found.columns == ["i", "k", "t", "k0", "last"]
    expected = [(*row, match(row)) for row in left]
    assert sorted(((*r[:4], r[4] and tuple(r[4])) for r in rows(found)), key=str) == sorted(expected, key=str)


def test_as_of_join_of_empty_tables(spark):
    some, none = spark.createDataFrame([(1, 5)], "k int, t int"), spark.createDataFrame([], "k int, t int")
    assert rows(asof.as_of_join(some, none, ["k"], "t")) == [(1, 5, None)]
    assert rows(asof.as_of_join(none, some, ["k"], "t")) == []
    with pytest.raises(ValueError):
        asof.as_of_join(some.withColumn("matched", F.lit(1)), some, ["k"], "t")


def test_a_hot_key_is_shared_by_ranges(spark):
    left = spark.range(20_000).selectExpr("1 AS k", "CAST(id % 3 AS INT) AS t")
    right = spark.createDataFrame([(1, 0, "x"), (1, 2, "y")], "k int, t int, v string")
    found = asof.as_of_join(left, right, ["k"], "t", ranges=16)
    assert dict(rows(found.groupBy("matched.v").count())) == {"x": 13_334, "y": 6_666}


def test_rollup_of_an_empty_table_and_merged_sketches(spark):
    counts = spark.range(30_000).selectExpr(
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, CAST(id % 50 AS INT)) AS bucket", "CAST(id AS STRING) AS user_hash",
        "IF(id % 3 = 0, 's3', 'ec2') AS service", "1L AS requests")
    assert rows(rollups.usage_rollup(counts.limit(0))) in ([], [(None, None, None, "all", None, 0)])
    total = {r["level"]: r["requests"] for r in rollups.usage_rollup(counts).where("level IN ('all', 'day')").collect()}
    assert total == {"all": 30_000, "day": 30_000}
    merged = rollups.merged_users(rollups.user_sketches(counts), "service").collect()
    for row, exact in zip(sorted(merged), (20_000, 10_000)):
        assert row["requests"] == exact and abs(row["unique_users"] - exact) < 4 * 1.04 / 64 * exact


def test_json_edges(spark):
    texts = ['{"a": {"b": {"c": {"d": 1}}}}', '{"a": 1.5, "A": "x"}', "[1, 2]", "3", "", "{", None, '{"a": {}}', '{"a b": [], "z": null}']
    df = spark.createDataFrame(list(enumerate(texts)), "row long, value string")
    assert rows(json_fields.json_quality(df, "value")) == [(9, 1, 2)]
    found = {(r["path"], r["type"]): r["n_rows"] for r in json_fields.discover_fields(df, "value", 3).collect()}
    assert found == {
        ("$.a", "object"): 2, ("$.a", "number"): 1, ("$.A", "string"): 1, ("$.a b", "array"): 1, ("$.z", "void"): 1,
        ("$.a.b", "object"): 1, ("$.a.b.c", "object"): 1,
    }
    shredded = json_fields.shred_fields(df, "value", {"n": ("$.a", "double"), "deep": ("$.a.b.c.d", "int")}, "bad")
    assert shredded.columns == ["row", "value", "n", "deep", "bad"]
    by_row = {r["row"]: tuple(r)[2:] for r in shredded.collect()}
    assert by_row[0] == (None, 1, False) and by_row[1] == (1.5, None, False) and by_row[4][2] and by_row[5][2] and by_row[6] == (None, None, False)
    assert json_fields.discover_fields(df.limit(0), "value").count() == 0
    with pytest.raises(ValueError):
        json_fields.shred_fields(df, "value", {"ROW": ("$.a", "int")})


def test_only_new_texts_are_embedded(spark, tmp_path):
    path, calls = str(tmp_path / "corpus"), tmp_path / "calls"
    calls.mkdir()
    folder = str(calls)

    def embed(texts):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w", encoding="utf-8") as out:
            out.write("\n".join(texts))
        return [[float(len(t))] for t in texts]

    def embedded():
        found = sorted(t for f in calls.iterdir() for t in f.read_text(encoding="utf-8").split("\n"))
        for f in calls.iterdir():
            f.unlink()
        return found

    def update(*texts):
        df = spark.createDataFrame([(i, d, t) for i, d, t in texts], "id long, domain string, text string")
        corpus.update_corpus(spark, df, path, embed, 1)
        stored = spark.read.parquet(path).collect()
        assert sorted((r["id"], r["domain"], r["text"]) for r in stored) == sorted(texts)
        assert all(r["embedding"] == [float(len(r["text"]))] for r in stored)

    def files():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "corpus").rglob("*.parquet")}

    a, b, c, d = (1, "x", "one"), (2, "x", "two"), (3, "y", "three"), (4, "z", "four")
    update(a, b, c)
    assert embedded() == ["one", "three", "two"]
    before = files()
    update(c, b, a)
    assert embedded() == [] and files() == before
    update(a, b, b, c, d)  # a copy and a new domain: nothing that is there is written again
    assert embedded() == ["four"] and before.items() <= files().items()
    kept = {p: t for p, t in files().items() if "domain=y" in p}
    update((1, "x", "one"), (5, "x", "five"), (2, "x", "two"), c)  # a copy less, a domain gone
    assert embedded() == ["five"] and kept.items() <= files().items()
    assert not (tmp_path / "corpus" / "domain=z").exists()


def test_rows_are_counted_from_footers(spark, tmp_path):
    assert sinks.write_counted(spark.range(1234), sinks.write_partitioned, str(tmp_path / "t"), "2024-01-01") == 1234
    text = spark.read.parquet(str(tmp_path / "t")).where("dt = '2024-01-01'").groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in text
    assert sinks.write_counted(spark.range(0), sinks.write_partitioned, str(tmp_path / "e"), "2024-01-01") == 0


def test_export_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "t.csv"
    sinks.export_csv(spark.createDataFrame([("é", 1)], "a string, b int"), str(path), byte_order_mark=True)
    found = [p.read_bytes() for p in path.glob("part-*")]
    assert any(f.startswith("﻿a;b\n".encode()) for f in found)
    assert rows(scan_auto(spark, str(path))) == [("é", "1")]


def test_decision_value_of_a_model_without_probabilities(spark):
    class Margin(Transformer):
        def _transform(self, dataset):
            return dataset.drop("probability")

    values = [(1, 1.0, Vectors.dense(-2.5, 2.5)), (2, 0.0, Vectors.dense(1.0, -1.0))]
    df = spark.createDataFrame(values, ["timestamp", "prediction", "rawPrediction"])
    assert rows(predict_supervised(Margin(), df)) == [(1, 1, 2.5), (2, 0, -1.0)]
    assert rows(predict_supervised(Margin(), df.drop("rawPrediction"))) == [(1, 1, 1.0), (2, 0, 0.0)]
