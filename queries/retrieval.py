"""Vector search, prompt assembly and batch answering."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from logquarry.operators import cells, routing, textify, vectors
from logquarry.plans import answering
from logquarry.plans import corpus as corpus_plan
from logquarry.session import shared_dir
from queries.inputs import (
    ASKED, CORPUS, DISTANCE, QUESTION_VECTORS, ROUTES, corpus, marts, question_vectors, questions,
    questions_with_vectors, table,
)
from queries.registry import query
from queries.texts import ANSWERS, FAQ, MARKER, layer_documents

TOP = 5
PAIRS = f"pairs AS (SELECT v.question_id, c.id, c.domain, {DISTANCE} AS d FROM corpus c CROSS JOIN question_vectors v)"


def rounded(hits):
    return hits.withColumn("score", F.round("score", 4))


def _ranked_sql(where: str) -> str:
    return f"""WITH {CORPUS}, {QUESTION_VECTORS}, {PAIRS},
    r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY d, id)::INTEGER AS rank FROM pairs {where})
    SELECT question_id, rank, id, round(d, 4) AS score FROM r WHERE rank <= {TOP}"""


@query("knn_filtered", _ranked_sql("WHERE domain = 'security'"))
def _(spark, sf):
    return rounded(vectors.knn_filtered(corpus(spark, sf), question_vectors(spark, sf), "security", TOP))


@query("knn_global", _ranked_sql(""))
def _(spark, sf):
    return rounded(vectors.knn_global(corpus(spark, sf), question_vectors(spark, sf), TOP))


@query("knn_global_shuffled", _ranked_sql(""))
def _(spark, sf):
    """The way taken by question sets of several shards."""
    return rounded(vectors.knn_global(corpus(spark, sf), question_vectors(spark, sf), TOP, broadcast_bytes=64 * 1024))


@query(
    "knn_multi_domain",
    f"""WITH {CORPUS}, {QUESTION_VECTORS}, {PAIRS},
    wanted(domain) AS (VALUES ('documentation_gold_cost'), ('documentation_gold_performance'), ('documentation_gold_security')),
    a AS (SELECT *, row_number() OVER (PARTITION BY question_id, domain ORDER BY d, id) AS place
          FROM pairs JOIN wanted USING (domain)),
    r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY d, id)::INTEGER AS rank FROM a WHERE place <= 2)
    SELECT question_id, rank, id, domain, round(d, 4) AS score FROM r WHERE rank <= {TOP}""",
)
def _(spark, sf):
    domains = F.array(*[F.lit(f"documentation_gold_{d}") for d in ("cost", "performance", "security")])
    routes = question_vectors(spark, sf).withColumn("domain", F.explode(domains))
    return rounded(vectors.knn_multi_domain(corpus(spark, sf), routes, TOP))


@query(
    "knn_project_then_filter",
    f"""WITH {CORPUS}, {QUESTION_VECTORS}, {PAIRS},
    r AS (SELECT a.question_id, a.id, a.d, row_number() OVER (PARTITION BY a.question_id ORDER BY a.d, a.id)::INTEGER AS rank
          FROM pairs a JOIN corpus c ON a.id = c.id
          WHERE a.domain = 'documentation_project' AND contains(c.text, '## Quem e o assistente'))
    SELECT question_id, rank, id, round(d, 4) AS score FROM r WHERE rank <= {TOP}""",
)
def _(spark, sf):
    marked = routing.marker_filter(corpus(spark, sf).withColumn("intent", F.lit("identity"))).drop("intent")
    return rounded(vectors.knn_filtered(marked, question_vectors(spark, sf), "documentation_project", TOP))


# Cells probed of about the square root of the corpus; the vectors given are spread evenly, so recall takes many.
PROBED_SHARE = 0.7
_INDEXES: dict[tuple[str, str], str] = {}


def _index(spark, sf):
    """The stored index of a folder's corpus, built once per application."""
    name = (spark.sparkContext.applicationId, sf)
    if name not in _INDEXES:
        path = shared_dir(spark, f"queries/cells-{uuid4().hex}")
        cells.build_index(corpus(spark, sf).select("id", "domain", "embedding"), path)
        _INDEXES[name] = path
    index = cells.open_index(spark, _INDEXES[name])
    return index, max(1, round(PROBED_SHARE * len(index.centres)))


@query("knn_approx")
def _(spark, sf):
    index, probes = _index(spark, sf)
    return cells.knn_probed(index, question_vectors(spark, sf), probes, TOP)


@query(
    "knn_approx_recall",
    f"WITH {QUESTION_VECTORS} SELECT count(*) AS questions, true AS recall_at_least_90, true AS scores_exact FROM question_vectors",
)
def _(spark, sf):
    """Approximate hits next to the exact ones: share of the exact ids found, and every score that of its pair."""
    index, probes = _index(spark, sf)
    asked = question_vectors(spark, sf)
    near = cells.knn_probed(index, asked, probes, TOP).select("question_id", "id", F.col("score").alias("near"))
    exact = vectors.knn_global(index.rows, asked, TOP).select("question_id", "id", "score")
    pairs = near.join(index.rows.select("id", "embedding"), "id").join(asked, "question_id")
    gaps = F.transform(F.arrays_zip("embedding", "q"), lambda p: F.pow(p["embedding"].cast("double") - p["q"].cast("double"), 2.0))
    true_score = F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x)
    checked = pairs.select("question_id", "id", (F.abs(true_score - F.col("near")) <= 1e-9 * (1 + true_score)).alias("true_score"))
    both = exact.join(checked, ["question_id", "id"], "full_outer")
    return both.agg(
        F.countDistinct(F.when(F.col("score").isNotNull(), F.col("question_id"))).alias("questions"),
        (F.count(F.when(F.col("score").isNotNull(), F.col("true_score"))) >= 0.9 * F.count("score")).alias("recall_at_least_90"),
        F.bool_and("true_score").alias("scores_exact"),
    )


@query("knn_indexed", _ranked_sql(""))
def _(spark, sf):
    """Exact search that reads only the cells which can hold a hit."""
    return rounded(cells.knn_indexed(_index(spark, sf)[0], question_vectors(spark, sf), TOP))


@query("knn_approx_all_cells", _ranked_sql(""))
def _(spark, sf):
    """With every cell probed the approximate search is the exact one."""
    index, _ = _index(spark, sf)
    return rounded(cells.knn_probed(index, question_vectors(spark, sf), len(index.centres), TOP))


@query("knn_approx_kept_share")
def _(spark, sf):
    index, probes = _index(spark, sf)
    return cells.read_share(index, question_vectors(spark, sf), probes)


@query("embed_texts")
def _(spark, sf):
    embedded = vectors.embed_texts(table(spark, sf, "documents").select("doc_id", "text"))
    return embedded.select("doc_id", F.size("embedding").alias("dim"), "embedding")


def letter_counts(texts: list[str]) -> list[list[float]]:
    """An embedding that SQL can repeat: the text's length and how often each of three letters occurs in it."""
    return [[float(len(t or "")), *[float((t or "").count(c)) for c in "aen"]] for t in texts]


@query(
    "embed_texts_hook",
    f"""SELECT doc_id, 4 AS dim, CAST(length(t) AS DOUBLE) AS length, {', '.join(f"CAST(length(t) - length(replace(t, '{c}', '')) AS DOUBLE) AS {c}" for c in "aen")}
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""",
)
def _(spark, sf):
    """Vectors of the caller's own function, by value."""
    embedded = vectors.embed_texts(table(spark, sf, "documents").select("doc_id", "text"), embed=letter_counts, dim=4)
    return embedded.select("doc_id", F.size("embedding").alias("dim"), *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(("length", *"aen"))])


@query("embed_texts_length", "SELECT doc_id, 768 AS dim, 1.0::DOUBLE AS length FROM documents")
def _(spark, sf):
    """Every default embedding has unit length."""
    embedded = vectors.embed_texts(table(spark, sf, "documents").select("doc_id", "text"))
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return embedded.select("doc_id", F.size("embedding").alias("dim"), F.round(F.sqrt(squares), 5).alias("length"))


HITS = f"""{ASKED}, {CORPUS}, {QUESTION_VECTORS}, {ROUTES},
sized AS (SELECT *, count(*) OVER (PARTITION BY intent) AS m FROM routes),
wanted AS (
  SELECT question_id, intent, domain, greatest(1, CAST(ceil({TOP}.0 / m) AS INTEGER)) AS n FROM asked JOIN sized USING (intent)
  UNION ALL
  SELECT question_id, intent, CASE WHEN intent IN ('security', 'cost', 'performance') THEN intent ELSE '*' END, {TOP}
  FROM asked WHERE intent NOT IN (SELECT intent FROM routes)),
near AS (
  SELECT *, row_number() OVER (PARTITION BY question_id, route ORDER BY d, id) AS place FROM (
    SELECT w.question_id, w.intent, w.domain AS route, w.n, c.id, c.domain, c.text, {DISTANCE} AS d
    FROM wanted w JOIN question_vectors v USING (question_id) JOIN corpus c ON w.domain = '*' OR c.domain = w.domain) AS x
  WHERE route <> 'documentation_project' OR {MARKER}),
hits AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY d, id)::INTEGER AS rank FROM near
    WHERE place <= n) AS r WHERE rank <= {TOP})"""

REPLACED = """replace(replace(replace(text, 'Acesso fora do horario normal: False.', 'Nao houve acesso fora do horario normal.'),
  'Acesso fora do horario normal: True.', 'Houve acesso fora do horario normal.'),
  'Nível de risco: normal.', 'Nivel de risco: normal.')"""

PROMPTS = f"""{HITS},
gathered AS (
  SELECT question_id, string_agg('Registro '||rank||': dominio='||domain||chr(10)||{REPLACED}||chr(10), chr(10) ORDER BY rank)
    AS records, bool_or(domain = 'documentation_project') AS is_project, count(*) AS n_hits FROM hits GROUP BY question_id),
prompts AS (
  SELECT question_id, n_hits, array_to_string([
    'Use as informações abaixo para responder à pergunta de forma objetiva e precisa.',
    'Não invente respostas além do contexto retornado.', 'Quando não souber a resposta, diga que não sabe.'], chr(10))
    ||CASE WHEN is_project THEN chr(10)||array_to_string(['Esta e uma pergunta explicativa sobre o projeto.',
      'Responda diretamente com paragrafos ou listas curtas.', 'Nao use os campos Conclusao e Evidencias.'], chr(10))
      ||CASE WHEN contains(f, 'pre processamento') OR contains(f, 'pre-processamento') THEN chr(10)
        ||'Sua resposta deve conter quatro topicos obrigatorios: Bronze, Silver, Gold e Treinamento de machine learning. '
        ||'Nao omita nenhum deles.' ELSE '' END ELSE '' END
    ||chr(10)||chr(10)||'Contexto disponivel:'||chr(10)||records||chr(10)||'Pergunta:'||chr(10)||question||chr(10)||chr(10)
    ||'Resposta final:' AS prompt
  FROM gathered JOIN asked USING (question_id))"""


def _hits(spark, sf):
    asked = routing.with_intent(questions_with_vectors(spark, sf)).withColumn("top_k", F.lit(TOP))
    return asked, answering.retrieve(asked, corpus(spark, sf))


@query(
    "batch_retrieve_hits",
    f"WITH {HITS} SELECT question_id, intent, rank, id, domain, round(d, 4) AS score, text FROM hits",
)
def _(spark, sf):
    return rounded(_hits(spark, sf)[1])


@query("assemble_context", f"WITH {PROMPTS} SELECT question_id, prompt FROM prompts")
def _(spark, sf):
    asked, hits = _hits(spark, sf)
    return textify.assemble_context(asked.select("question_id", "question"), hits)


@query(
    "format_hits",
    f"""WITH {HITS} SELECT question_id, '=== Documentos Recuperados ==='||chr(10)||string_agg('- id='||id||' domain='||domain
        ||' distancia_vetorial='||printf('%.4f', d)||chr(10)||'  texto='||text, chr(10) ORDER BY rank) AS listing
    FROM hits GROUP BY question_id""",
)
def _(spark, sf):
    return textify.format_hits(_hits(spark, sf)[1])


@query(
    "batch_retrieve",
    f"""WITH {PROMPTS} SELECT question_id, question, intent, CASE WHEN prompt IS NULL THEN 'not_found' ELSE 'ok' END AS status,
        prompt, CASE WHEN prompt IS NULL THEN '' ELSE {FAQ} END AS answer,
        CASE WHEN prompt IS NULL OR contains(f,'quem e voce') OR contains(f,'quem voce e') THEN 0 ELSE n_hits END::INTEGER
          AS n_sources
    FROM asked LEFT JOIN prompts USING (question_id)""",
)
def _(spark, sf):
    answered = answering.batch_retrieve(questions_with_vectors(spark, sf), corpus(spark, sf), ANSWERS, top_k=TOP)
    return answered.withColumn("n_sources", F.size("sources")).drop("sources")


@query("answer_questions")
def _(spark, sf):
    """From raw logs and documents to answers: the corpus is built, embedded by the default and searched."""
    path = shared_dir(spark, "queries/answer_questions")
    corpus_plan.write_corpus(corpus_plan.build_corpus(marts(spark, sf), layer_documents(spark, sf), "Plataforma"), path)
    answered = answering.batch_retrieve(questions(spark, sf), spark.read.parquet(path), ANSWERS, top_k=TOP)
    return answered.select("question_id", "intent", "status", "prompt", "answer", F.size("sources").alias("n_sources"))
