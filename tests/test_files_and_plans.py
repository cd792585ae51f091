import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from logquarry.plans.bronze import csv_to_bronze
from logquarry.plans.corpus import corpus_texts, layer_documents
from logquarry.plans.gold import build_marts, silver_to_gold
from logquarry.plans.silver import bronze_to_silver, clean_logs
from logquarry.plans.training import predict_from_marts, train_from_marts
from logquarry.sources import sinks, snapshots
from logquarry.sources.logs import MART_SCHEMAS, scan_auto
from logquarry.streaming.marts import stream_cost, stream_performance
from queries.inputs import raw_logs


def touch(spark, path, value):
    spark.createDataFrame([(value,)], "v int").coalesce(1).write.mode("overwrite").parquet(str(path))


def test_latest_snapshot_path(spark, tmp_path):
    base = str(tmp_path)
    assert snapshots.latest_snapshot_path(spark, base, "cost", "cost") is None
    touch(spark, tmp_path / "cost/dt=2024-01-01/cost.parquet", 1)
    touch(spark, tmp_path / "cost/dt=2024-01-02/cost.parquet", 2)
    (tmp_path / "cost/dt=2024-01-02/cost.csv").write_text("v\n3\n")
    found = snapshots.latest_snapshot_path(spark, base, "cost", "cost")
    assert found.endswith("dt=2024-01-02/cost.parquet")
    touch(spark, tmp_path / "other/deep/dt=2024-01-09/security.parquet", 4)
    assert snapshots.latest_snapshot_path(spark, base, "security", "security").endswith("dt=2024-01-09/security.parquet")


def test_first_available_source(spark, tmp_path):
    touch(spark, tmp_path / "lake/cost/dt=2024-01-01/cost.parquet", 1)
    touch(spark, tmp_path / "local/cost/dt=2023-01-01/cost.parquet", 2)
    bases = [str(tmp_path / x) for x in ("none", "local", "lake")]
    assert rows(snapshots.first_available_source(spark, "cost", "cost", bases).select("v")) == [(2,)]
    with pytest.raises(FileNotFoundError):
        snapshots.first_available_source(spark, "cost", "cost", bases[:1])


def test_expected_or_last_path(spark, tmp_path):
    base = str(tmp_path / "silver")
    assert snapshots.expected_or_last_path(spark, base, "2024-01-01") is None
    for day in (1, 2):
        touch(spark, tmp_path / f"silver/dt=2024-01-0{day}/cleaned_logs.parquet", day)
    assert "dt=2024-01-01" in snapshots.expected_or_last_path(spark, base, "2024-01-01")
    assert "dt=2024-01-02" in snapshots.expected_or_last_path(spark, base, "2024-01-07")


def test_snapshot_filters_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        sinks.write_partitioned(spark.range(5), path, day)
    df = spark.read.parquet(path)
    latest = snapshots.latest_snapshot(df)
    assert {str(r["dt"]) for r in latest.collect()} == {"2024-01-03"}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "(dt" in plan.split("PartitionFilters")[1][:200]
    assert {str(r["dt"]) for r in snapshots.expected_or_last_snapshot(df, "2024-01-02").collect()} == {"2024-01-02"}
    assert {str(r["dt"]) for r in snapshots.expected_or_last_snapshot(df, "2023-05-05").collect()} == {"2024-01-03"}


def test_stored_days(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        snapshots.read_expected_or_last_day(spark, path)
    for day, n in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)):
        sinks.write_partitioned(spark.range(n), path, day)
    days = ("2024-01-02", "2023-05-05", None)
    assert [snapshots.read_expected_or_last_day(spark, path, day).count() for day in days] == [2, 3, 3]
    assert snapshots.read_day(spark, path, "2024-01-01").columns == ["id"]
    with pytest.raises(FileNotFoundError):
        snapshots.read_day(spark, path, "2023-05-05")


def test_rerun_replaces_its_day_only(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitioned(spark.range(5), path, "2024-01-01")
    sinks.write_partitioned(spark.range(7), path, "2024-01-02")
    sinks.write_partitioned(spark.range(2), path, "2024-01-02")
    assert sorted((str(r[0]), r[1]) for r in rows(spark.read.parquet(path).groupBy("dt").count())) == [
        ("2024-01-01", 5), ("2024-01-02", 2),
    ]


def test_export_round_trip(spark, tmp_path):
    mart = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-01 10:00:00' AS timestamp, DATE '2024-01-01' AS date, '10:00' AS hora_completa, "
        "'s3;x' AS service, 3L AS requests, 0.000012D AS cost"
    )
    path = str(tmp_path / "cost.csv")
    sinks.export_csv(mart, path)
    lines = "\n".join(p.read_text(encoding="utf-8") for p in (tmp_path / "cost.csv").glob("part-*"))
    assert lines.splitlines() == [
        "timestamp;date;hora_completa;service;requests;cost",
        '2024-01-01 10:00:00;2024-01-01;10:00;"s3;x";3;0.00001200',
    ]
    assert rows(scan_auto(spark, path, MART_SCHEMAS["cost"])) == rows(mart)


def document(spark, path):
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).select("value").collect())


def test_file_to_gold(spark, sf_dir, tmp_path):
    source, bronze, silver, gold, notes = (str(tmp_path / x) for x in ("in.csv", "bronze", "silver", "gold", "notes"))
    raw = raw_logs(spark, sf_dir)
    raw.write.option("header", True).option("escape", '"').option("nullValue", "NaN").csv(source)
    day, when = "2024-02-01", "2024-02-01 00:00:00"
    csv_to_bronze(spark, source, bronze, f"{notes}/bronze", day, when)
    landed = spark.read.parquet(bronze).drop("dt")
    assert landed.count() == raw.count() and landed.where("eventname = 'NaN'").count() > 0
    bronze_to_silver(spark, bronze, silver, f"{notes}/silver", day, when)
    stored = silver_to_gold(spark, silver, gold, day, when)
    expected = build_marts(clean_logs(raw))
    for domain, mart in stored.items():
        assert sorted(rows(mart)) == sorted(rows(expected[domain]))
    exported = scan_auto(spark, f"{gold}/csv/cost/dt={day}/part-*.csv", MART_SCHEMAS["cost"])
    assert exported.count() == expected["cost"].count()
    text = document(spark, f"{gold}/documents/dt={day}/dataset=cost")
    assert "# Documentação do Dataset Cost" in text and f"- **Quantidade de linhas:** {stored['cost'].count()}" in text
    assert "### service" in text and "Serviço inferido a partir do nome do evento." in text
    text = document(spark, f"{notes}/silver/dt={day}")
    assert f"- **Linhas originais:** {raw.count()}" in text and f"- **Destino:** {silver}/dt={day}" in text
    assert "- **sourceipaddress**" in document(spark, f"{notes}/bronze/dt={day}")

    patterns = {
        "documentation_bronze": f"{notes}/bronze/dt=*/dataset=bronze",
        "documentation_silver": f"{notes}/silver/dt=*/dataset=silver",
        "documentation_gold_cost": f"{gold}/documents/dt=*/dataset=cost",
        "documentation_gold_security": f"{gold}/documents/dt=*/dataset=missing",
    }
    documents = layer_documents(spark, patterns)
    assert {r["domain"] for r in documents.collect()} == set(list(patterns)[:3])
    texts = corpus_texts(stored, documents, "P", n=10).collect()
    assert sum(t["domain"] == "cost" for t in texts) == 10
    sections = [t["text"] for t in texts if t["domain"] == "documentation_gold_cost"]
    assert any(t.endswith("### service\n\nServiço inferido a partir do nome do evento.") for t in sections)
    assert all(t.startswith("Fonte: ") and "\nCamada/documentacao: documentation_gold_cost\n\n" in t for t in sections)

    fewer = {"random_forest": {"trees": 5}, "isolation_forest": {"trees": 20}}
    models = str(tmp_path / "models")
    result = train_from_marts(
        spark, [str(tmp_path / "none"), gold], models, options=fewer, supervised=("random_forest",)
    )
    assert result.summary.count() == 2
    predictions = predict_from_marts(spark, [gold], f"{models}/isolation_forest", str(tmp_path / "predictions"))
    assert predictions.count() == stored["performance"].count()
    written = spark.read.option("header", True).csv(str(tmp_path / "predictions"))
    assert written.columns == ["timestamp", "prediction", "score"] and written.count() == predictions.count()


@pytest.mark.parametrize("build", [stream_cost, stream_performance])
def test_streamed_marts_equal_batch_marts(spark, tmp_path, build):
    base = dt.datetime(2024, 1, 1)
    events = [
        (base + dt.timedelta(seconds=20 * i), "GetObject" if i % 3 else "RunInstances", f"u{i % 4}" if i % 5 else None)
        for i in range(60)
    ]
    schema = "timestamp timestamp_ntz, event string, user_hash string"
    source = str(tmp_path / "in")
    batch = spark.createDataFrame(events, schema)
    batch.coalesce(1).write.parquet(source)
    late = base + dt.timedelta(hours=5)
    spark.createDataFrame([(late, "ListUsers", "x")], schema).coalesce(1).write.mode("append").parquet(source)
    name = f"out_{build.__name__}"
    query = (
        build(spark.readStream.schema(schema).parquet(source)).writeStream.format("memory").queryName(name)
        .option("checkpointLocation", str(tmp_path / "checkpoint")).outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    domain = "cost" if build is stream_cost else "performance"
    expected = build_marts(batch)[domain]
    found = spark.table(name).where(F.col("timestamp") < F.lit(late))
    assert sorted(rows(found)) == sorted(rows(expected))
