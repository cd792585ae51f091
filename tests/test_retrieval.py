import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from logquarry.fixed_values import VECTOR_DIM
from logquarry.operators import cells, vectors
from logquarry.plans import answering, corpus
from queries import QUERIES
from queries.inputs import corpus as corpus_of
from queries.inputs import question_vectors

RNG = np.random.default_rng(5)
DOMAINS = ["cost", "security", "documentation_gold_cost", "documentation_project"]


def table(spark, n, copies=0, dim=8):
    """n vectors, of which the last `copies` are the same one."""
    data = RNG.normal(size=(n, dim)).astype(np.float32)
    if copies:
        data[-copies:] = data[-1]
    found = [(i, DOMAINS[i % 4], f"text {i}", data[i].tolist()) for i in range(n)]
    df = spark.createDataFrame(found, "id long, domain string, text string, embedding array<float>")
    return df.repartition(5), data


def asked(spark, n, dim=8):
    data = RNG.normal(size=(n, dim)).astype(np.float32)
    df = spark.createDataFrame([(i, data[i].tolist()) for i in range(n)], "question_id long, q array<float>")
    return df.repartition(3), data


def nearest(data, q, k, ids):
    distance = ((data[ids].astype(np.float64) - q.astype(np.float64)) ** 2).sum(1)
    order = sorted(zip(distance, ids))[:k]
    return [i for _, i in order]


def by_question(df):
    found = {}
    for r in df.orderBy("question_id", "rank").collect():
        found.setdefault(r["question_id"], []).append(r["id"])
    return found


@pytest.mark.parametrize("broadcast_bytes", [vectors.BROADCAST_BYTES, 200])
@pytest.mark.parametrize("copies", [0, 100])
def test_knn_against_brute_force(spark, monkeypatch, broadcast_bytes, copies):
    """Also with a third of the corpus being copies of one vector, and blocks smaller than the copies."""
    monkeypatch.setattr(vectors, "QUESTION_BLOCK", 4)
    df, data = table(spark, 300, copies)
    questions, q = asked(spark, 20)
    found = by_question(vectors.knn_global(df, questions, 7, broadcast_bytes=broadcast_bytes))
    assert found == {i: nearest(data, q[i], 7, np.arange(300)) for i in range(20)}
    inside = by_question(vectors.knn_filtered(df, questions, "security", 7, broadcast_bytes=broadcast_bytes))
    assert inside == {i: nearest(data, q[i], 7, np.arange(1, 300, 4)) for i in range(20)}


def test_many_questions_do_not_pass_through_the_driver(spark, monkeypatch):
    """Groups of a few vectors on both sides; per key, per array of keys and without."""
    monkeypatch.setattr(vectors, "_question_blocks", None)
    monkeypatch.setattr(vectors, "GROUP_BYTES", 1000)
    monkeypatch.setattr(vectors, "CORPUS_BLOCK", 7)
    df, data = table(spark, 120, 40)
    data[:3] *= 1e18
    df = spark.createDataFrame([(r["id"], r["domain"], r["text"], data[r["id"]].tolist()) for r in df.collect()], df.schema)
    questions, q = asked(spark, 40)
    found = by_question(vectors.knn_global(df, questions, 7, broadcast_bytes=200))
    assert found == {i: nearest(data, q[i], 7, np.arange(120)) for i in range(40)}
    half = F.col("question_id") % 2 == 0
    routes = questions.withColumns({"domain": F.when(half, "*").otherwise("cost"), "n": F.when(half, 4).otherwise(50)})
    found = by_question(vectors.knn_routed(df, routes, broadcast_bytes=200))
    assert found == {i: nearest(data, q[i], *((4, np.arange(120)) if i % 2 == 0 else (50, np.arange(0, 120, 4)))) for i in range(40)}


def test_sparse_vectors_travel_without_their_zeros(spark, monkeypatch):
    """Groups of vectors that are mostly zeros next to full ones, copies and vectors of zeros alone give what brute force gives."""
    monkeypatch.setattr(vectors, "GROUP_BYTES", 2000)
    monkeypatch.setattr(vectors, "CORPUS_BLOCK", 7)
    data, q = ((RNG.random((n, 60)) < 0.05) * RNG.integers(1, 4, (n, 60)).astype(np.float32) for n in (200, 40))
    data[150:] = data[150]
    data[100], data[7] = RNG.normal(size=60), 0
    corpus_rows = [(i, DOMAINS[i % 4], v.tolist()) for i, v in enumerate(data)]
    df = spark.createDataFrame(corpus_rows, "id long, domain string, embedding array<float>").repartition(5)
    questions = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "question_id long, q array<float>").repartition(3)
    found = by_question(vectors.knn_global(df, questions, 7, broadcast_bytes=200))
    assert found == {i: nearest(data, q[i], 7, np.arange(200)) for i in range(40)}
    routes = questions.withColumns({"domain": F.lit("cost"), "n": F.lit(60)})
    found = by_question(vectors.knn_routed(df, routes, broadcast_bytes=200))
    assert found == {i: nearest(data, q[i], 60, np.arange(0, 200, 4)) for i in range(40)}
    assert vectors.packed_share(df, "embedding")[1] < 0.5
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(2000)), pa.array([[0.0] * 767 + [1.0]] * 2000, pa.list_(pa.float32())), pa.array(np.zeros(2000, np.int32))], names=["ident", "vector", "g"]
    )
    blobs = [group["rows"][0].as_py() for group in vectors.packed_groups(batch, "g")]
    assert sum(map(len, blobs)) < 2000 * 768 * 4 / 50
    assert (vectors.unpacked(pa.chunked_array([pa.array(blobs, pa.binary())]), "vector", "Corpus")[1][:] == batch["vector"].to_pylist()).all()


def test_spare_copies_are_found_by_hashes(monkeypatch):
    """Of equal vectors the lowest ids stay; different ones that share a hash all do."""
    data = RNG.integers(0, 2, (300, 6)).astype(np.float32)
    ids = RNG.permutation(300)
    expected = sorted(i for i in range(300) if sum((data[i] == data[j]).all() and ids[j] < ids[i] for j in range(300)) < 3)
    for form in (data, vectors.SparseRows.of(data)):
        assert vectors._without_spare_copies(ids, form, 3).tolist() == expected
    monkeypatch.setattr(vectors, "_row_hashes", lambda rows: np.zeros(len(rows), dtype=np.uint64))
    assert vectors._without_spare_copies(ids, data, 3).tolist() == list(range(300))


def test_scores_are_squared_distances(spark):
    df = spark.createDataFrame([(1, "d", [0.0, 3.0]), (2, "d", None)], "id long, domain string, embedding array<float>")
    questions = spark.createDataFrame([(9, [4.0, 0.0])], "question_id long, q array<float>")
    assert rows(vectors.knn_global(df, questions, 5)) == [(9, 1, 1, 25.0)]


def test_different_dimensions_are_refused(spark):
    df, _ = table(spark, 10)
    questions, _ = asked(spark, 2, dim=5)
    with pytest.raises(Exception, match="numbers"):
        vectors.knn_global(df, questions, 2).collect()


@pytest.mark.parametrize("k, quota", [(1, 1), (2, 1), (5, 2), (50, 17)])
def test_multi_domain_quota(spark, k, quota):
    df, data = table(spark, 80)
    questions, q = asked(spark, 6)
    wanted = DOMAINS[:3]
    routes = questions.withColumn("domain", F.explode(F.array(*[F.lit(d) for d in wanted])))
    found = by_question(vectors.knn_multi_domain(df, routes, k))
    for i in range(6):
        pool = [j for d in range(3) for j in nearest(data, q[i], quota, np.arange(d, 80, 4))]
        assert found[i] == nearest(data, q[i], k, np.array(pool))


def test_routes_mix_domains_and_whole_corpus(spark):
    df, data = table(spark, 60)
    questions, q = asked(spark, 2)
    routes = questions.withColumns(
        {"domain": F.when(F.col("question_id") == 0, "*").otherwise("cost"), "n": F.when(F.col("question_id") == 0, 4).otherwise(30)}
    )
    found = by_question(vectors.knn_routed(df, routes))
    assert found == {0: nearest(data, q[0], 4, np.arange(60)), 1: nearest(data, q[1], 30, np.arange(0, 60, 4))}


@pytest.mark.parametrize("copies, n_cells", [(100, None), (0, 1), (0, 40)])
def test_index_gives_exact_results(spark, tmp_path, copies, n_cells):
    df, data = table(spark, 300, copies)
    odd = spark.createDataFrame([(1000, "cost", "t", None)], df.schema)
    questions, q = asked(spark, 20)
    questions = questions.unionByName(spark.createDataFrame([(99, None)], questions.schema))
    cells.build_index(df.unionByName(odd), str(tmp_path), n_cells)
    index = cells.open_index(spark, str(tmp_path))
    assert index.rows.count() == 300 and index.sizes.sum() == 300
    want = {i: nearest(data, q[i], 7, np.arange(300)) for i in range(20)}
    assert by_question(cells.knn_indexed(index, questions, 7, probes=2)) == want
    assert by_question(cells.knn_indexed(index, questions, 7, probes=1, broadcast_bytes=200)) == want
    assert by_question(cells.knn_probed(index, questions, len(index.centres), 7)) == want
    assert by_question(cells.knn_indexed(index, questions, 400, probes=1)) == {i: nearest(data, q[i], 400, np.arange(300)) for i in range(20)}


@pytest.mark.parametrize("group_bytes", [300, 1 << 20])
def test_many_questions_meet_the_index_in_groups(spark, tmp_path, monkeypatch, group_bytes):
    """No question is repeated per cell it probes; a cell may be larger than a group."""
    monkeypatch.setattr(vectors, "_question_blocks", None)
    monkeypatch.setattr(vectors, "GROUP_BYTES", group_bytes)
    df, data = table(spark, 200, 50)
    questions, q = asked(spark, 30)
    cells.build_index(df, str(tmp_path), 6)
    index = cells.open_index(spark, str(tmp_path))
    want = {i: nearest(data, q[i], 7, np.arange(200)) for i in range(30)}
    assert by_question(cells.knn_indexed(index, questions, 7, probes=2, broadcast_bytes=200)) == want
    assert by_question(cells.knn_probed(index, questions, 6, 7, broadcast_bytes=200)) == want
    cell = {r["id"]: r["cell"] for r in index.rows.select("id", "cell").collect()}
    near = np.argsort(((q[:, None].astype(float) - index.centres[None]) ** 2).sum(2), axis=1)[:, :2]
    held = {i: np.array([j for j in range(200) if cell[j] in near[i]]) for i in range(30)}
    assert by_question(cells.knn_probed(index, questions, 2, 7, broadcast_bytes=200)) == {i: nearest(data, q[i], 7, held[i]) for i in range(30)}


def test_index_passes_over_far_cells(spark, tmp_path):
    """Groups of vectors far from each other: the second pass opens none of them, a probe reads one folder."""
    rng = np.random.default_rng(1)
    data = (np.eye(8)[rng.integers(8, size=400)] * 100 + rng.normal(size=(400, 8))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id long, embedding array<float>")
    cells.build_index(df, str(tmp_path), 8)
    index = cells.open_index(spark, str(tmp_path))
    questions = spark.createDataFrame([(i, data[i].tolist()) for i in range(10)], "question_id long, q array<float>")
    assert by_question(cells.knn_indexed(index, questions, 5, probes=1)) == {i: nearest(data, data[i], 5, np.arange(400)) for i in range(10)}
    assert rows(cells.read_share(index, questions, 1))[0][0] < 0.3
    bounds = questions.withColumn("bound", F.lit(50.0))
    assert cells._cells_within(index, bounds, 1).count() < 10


def test_index_of_an_empty_corpus(spark, tmp_path):
    df, _ = table(spark, 3)
    cells.build_index(df.limit(0), str(tmp_path))
    questions, _ = asked(spark, 2)
    assert cells.knn_indexed(cells.open_index(spark, str(tmp_path)), questions, 3).count() == 0


@pytest.mark.parametrize("bad", [[1.0, float("nan")], [float("inf"), 0.0], [None, 1.0]])
def test_vectors_that_are_not_finite_are_refused(spark, bad):
    good = spark.createDataFrame([(1, "cost", [1.0, 2.0])], "id long, domain string, embedding array<float>")
    odd = spark.createDataFrame([(2, "cost", bad)], good.schema)
    questions = spark.createDataFrame([(1, [0.0, 1.0])], "question_id long, q array<float>")
    with pytest.raises(Exception, match="not finite"):
        vectors.knn_global(good.unionByName(odd), questions, 1).collect()
    with pytest.raises(Exception, match="not finite"):
        vectors.knn_global(good, odd.selectExpr("id AS question_id", "embedding AS q"), 1).collect()


def test_default_embedding_has_unit_length(spark):
    df = spark.createDataFrame([(1, "Um texto um"), (2, ""), (3, None)], "id int, text string")
    found = {r["id"]: np.array(r["embedding"]) for r in vectors.embed_texts(df, dim=32).collect()}
    assert all(len(v) == 32 for v in found.values())
    assert np.linalg.norm(found[1]) == pytest.approx(1.0, abs=1e-6)
    assert sorted(np.unique(np.round(found[1], 4))) == pytest.approx([0.0, 0.4472, 0.8944], abs=1e-4)


def test_embedding_hook(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(10)], "id int, text string")

    def lengths(texts):
        return [[float(len(x)), 1.0] for x in texts]

    found = {r["id"]: r["embedding"] for r in vectors.embed_texts(df, embed=lengths, dim=2, batch=3).collect()}
    assert found == {i: [float(i), 1.0] for i in range(10)}
    with pytest.raises(Exception, match="length 3"):
        vectors.embed_texts(df, embed=lengths, dim=3).collect()


ANSWERS = {"identity": "Eu sou o assistente.", "preprocessing": "Limpeza."}


def small_corpus(spark):
    found = [
        (1, "documentation_project", "## Quem e o assistente\nsou eu", [1.0, 0.0]),
        (2, "documentation_project", "## Outros", [0.0, 0.0]),
        (3, "documentation_project", "## Pre-processamento dos dados\nx", [0.0, 1.0]),
        (4, "cost", "Acesso fora do horario normal: False.", [0.0, 0.0]),
        (5, "documentation_gold_cost", "gold", [0.5, 0.0]),
    ]
    return spark.createDataFrame(found, "id long, domain string, text string, embedding array<float>")


def ask(spark, texts, top_k=None):
    df = spark.createDataFrame([(i, x, [0.0, 0.0]) for i, x in enumerate(texts)], "question_id long, question string, q array<float>")
    return df if top_k is None else df.withColumn("top_k", F.lit(top_k))


def test_batch_retrieve(spark):
    questions = ask(spark, ["Quem é você?", "risco", "custo total", "pré-processamento", "oi", "gold", "quais métricas"])
    found = {r["question_id"]: r for r in answering.batch_retrieve(questions, small_corpus(spark), ANSWERS).collect()}
    assert {i: r["status"] for i, r in found.items()} == {
        0: "ok", 1: "not_found", 2: "ok", 3: "ok", 4: "ok", 5: "ok", 6: "not_found",
    }
    assert found[0]["answer"] == "Eu sou o assistente." and found[0]["sources"] == []
    assert found[1]["prompt"] is None and found[1]["sources"] == [] and found[1]["answer"] == ""
    assert [s["id"] for s in found[2]["sources"]] == [4]
    assert "Registro 1: dominio=cost\nNao houve acesso fora do horario normal.\n\nPergunta:\ncusto total\n\nResposta final:" in found[2]["prompt"]
    assert [s["id"] for s in found[3]["sources"]] == [3]
    assert "quatro topicos obrigatorios" in found[3]["prompt"] and "quatro topicos" not in found[0]["prompt"]
    assert [s["id"] for s in found[4]["sources"]] == [2, 4, 5, 1, 3]
    assert [s["id"] for s in found[5]["sources"]] == [5]
    assert found[4]["sources"][2].asDict() == {"id": 5, "domain": "documentation_gold_cost", "score": 0.25, "text": "gold"}


def test_hits_are_ranked_before_texts_are_joined(spark):
    """Rows of one id count each, and what has no place among the top k is left before its text is fetched."""
    texts = spark.createDataFrame([(i, "cost", t, [0.0]) for i, t in ((1, "a"), (1, "b"), (2, "c"), (3, "d"))], "id long, domain string, text string, embedding array<float>")
    hits = spark.createDataFrame([(7, i, float(i), 3) for i in (1, 2, 3)], "question_id long, id long, score double, top_k int")
    placed = answering.placed_hits(hits, texts)
    assert "text" not in placed.columns and sorted((r["id"], r["before"]) for r in placed.collect()) == [(1, 0), (2, 2)]
    asked = spark.createDataFrame([(7, "cost", [0.0], 5)], "question_id long, intent string, q array<float>, top_k int")
    found = answering.retrieve(asked, texts).orderBy("rank").select("rank", "id").collect()
    assert [r["rank"] for r in found] == [1, 2, 3, 4, 5] and {r["id"] for r in found} == {1, 2}


def test_groups_are_numbered_for_the_least_shuffle(spark):
    session_tasks = vectors.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    for corpus_bytes, question_bytes in ((31 << 20, 57 << 20), (900 << 20, 10 << 20), (1, 1), (0, 500 << 20)):
        a, b = vectors.balanced_groups(spark, corpus_bytes, question_bytes)
        c, d = vectors.group_numbers(spark, corpus_bytes, question_bytes)
        assert a * b >= session_tasks and a * vectors.GROUP_BYTES >= corpus_bytes and b * vectors.GROUP_BYTES >= question_bytes
        assert a * question_bytes + b * corpus_bytes <= c * question_bytes + d * corpus_bytes
    assert vectors.balanced_groups(spark, 31 << 20, 57 << 20)[0] > 1


def test_questions_are_embedded_like_the_corpus(spark):
    texts = spark.createDataFrame(
        [(1, "cost", "custo do servico ec2"), (2, "cost", "outra coisa"), (3, "cost", "custo total do mes")],
        "id long, domain string, text string",
    )
    found = answering.batch_retrieve(
        spark.createDataFrame([(1, "custo do servico ec2")], "question_id long, question string"),
        vectors.embed_texts(texts, dim=64), {}, top_k=2, dim=64,
    ).first()
    assert [s["id"] for s in found["sources"]] == [1, 3] and found["sources"][0]["score"] < 1e-9


def test_top_k_belongs_to_the_question(spark):
    found = answering.batch_retrieve(ask(spark, ["oi", "custo"], 2), small_corpus(spark), {}).collect()
    assert {r["question_id"]: len(r["sources"]) for r in found} == {0: 2, 1: 1}


def test_hits_are_joined_by_shuffle_when_many(spark):
    hits = spark.createDataFrame([(1, 0)], "id long, question_id long")
    few = answering.attach_texts(hits, small_corpus(spark), 1)
    many = answering.attach_texts(hits, small_corpus(spark), 10**12)
    assert rows(few) == rows(many)


def test_corpus_ids_are_stable_and_partitioned_by_domain(spark, sf_dir, tmp_path):
    from queries.inputs import marts
    from queries.texts import layer_documents

    build = lambda: corpus.build_corpus(marts(spark, sf_dir), layer_documents(spark, sf_dir), "P", dim=16, n=20)
    first, second = ({(r["id"], r["domain"]) for r in build().collect()} for _ in range(2))
    assert first == second and len({i for i, _ in first}) == len(first) and min(first)[0] >= 0
    path = str(tmp_path / "corpus")
    corpus.write_corpus(build(), path)
    read = spark.read.parquet(path)
    assert read.count() == len(first)
    plan = read.where("domain = 'cost'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(domain" in plan
    assert read.where("domain = 'cost'").count() == 20


def test_documents_are_embedded_at_the_default_dimension(spark, sf_dir):
    found = QUERIES["embed_texts"](spark, sf_dir).groupBy("dim").count().collect()
    assert [tuple(r) for r in found] == [(VECTOR_DIM, spark.read.parquet(f"{sf_dir}/documents.parquet").count())]
