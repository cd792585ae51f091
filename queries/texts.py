"""Sentences, chunks, questions, prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from logquarry.fixed_values import FAQ_RULES, GENERIC_PHRASES
from logquarry.functions import text as t
from logquarry.operators import routing, textify
from logquarry.plans import corpus as corpus_plan
from queries.inputs import (
    ASKED, CORPUS, FOLDED, MD_DOCUMENTS, QUESTIONS, ROUTES, corpus, marts, marts_sql, md_documents, questions, table,
)
from queries.registry import query

SENTENCES = """sentences AS (
  SELECT 'cost' AS domain, "timestamp", service AS k, 'No dia '||date||' as '||hora_completa||', o servico '||service
    ||' recebeu '||requests||' requisicoes, com um custo estimado de $'||cost||'.' AS text FROM cost
  UNION ALL SELECT 'performance', "timestamp", '', 'Em '||date||' as '||hora_completa||', o sistema processou '||requests
    ||' eventos de '||unique_users||' usuarios unicos.' FROM performance
  UNION ALL SELECT 'security', "timestamp", user_hash, 'Alerta de seguranca: Em '||date||' as '||hora_completa||', o usuario '
    ||user_hash||' gerou '||requests||' requisicoes. Nivel de risco: '||risk_level||'. Acesso fora do horario normal: '
    ||CASE WHEN is_off_hours THEN 'True' ELSE 'False' END||'.' FROM security)"""


@query("textify_rows", f"WITH {marts_sql()}, {SENTENCES} SELECT domain, text FROM sentences")
def _(spark, sf):
    parts = [textify.textify_rows(mart, domain).select("domain", "text") for domain, mart in marts(spark, sf).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SECTIONS = f"""{MD_DOCUMENTS},
cut AS (SELECT doc_id, list_filter(list_transform(string_split(
    regexp_replace(trim(text, E' \\t\\n\\r'), E'(^|\\n)(#{{1,6}}\\\\s)', E'\\\\1\\x01\\\\2', 'g'), chr(1)),
    lambda s: trim(s, E' \\t\\n\\r')), lambda s: s <> '') AS parts FROM md_documents),
sections AS (SELECT doc_id, CAST(i AS INTEGER) AS section_no, parts[i + 1] AS section
  FROM (SELECT doc_id, parts, unnest(range(len(parts))) AS i FROM cut) AS u)"""


@query("chunk_sections", f"WITH {SECTIONS} SELECT * FROM sections")
def _(spark, sf):
    return textify.chunk_sections(md_documents(spark, sf))


def chunks_sql(limit: int, source: str) -> str:
    """Recursive cut of `source`(doc_id, section_no, section): the same rule, spelled as a loop over rest texts."""
    head = f"left(rest, {limit})"
    last = f"CASE WHEN contains({head}, chr(10)) THEN {limit} - position(chr(10) IN reverse({head})) ELSE -1 END"
    cut = f"CASE WHEN {last} > 0 THEN {last} ELSE {limit} END"
    return f"""pieces AS (
  SELECT doc_id, section_no, 0 AS step, CAST(NULL AS VARCHAR) AS chunk, section AS rest FROM {source}
  UNION ALL
  SELECT doc_id, section_no, step + 1,
         CASE WHEN length(rest) > {limit} THEN trim(left(rest, {cut}), E' \\t\\n\\r') ELSE rest END,
         CASE WHEN length(rest) > {limit} THEN trim(substr(rest, {cut} + 1), E' \\t\\n\\r') ELSE '' END
  FROM pieces WHERE rest <> ''),
chunks AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section_no, step) - 1 AS INTEGER) AS chunk_no, chunk
  FROM pieces WHERE chunk IS NOT NULL AND chunk <> '')"""


@query(
    "chunk_wrap",
    f"""WITH RECURSIVE plain AS (SELECT doc_id, 0 AS section_no, trim(text, E' \\t\\n\\r') AS section FROM documents
        WHERE trim(text, E' \\t\\n\\r') <> ''), {chunks_sql(3000, 'plain')} SELECT * FROM chunks""",
)
def _(spark, sf):
    return textify.chunk_wrap(table(spark, sf, "documents").select("doc_id", "text"))


@query("chunk_wrap_short", f"WITH RECURSIVE {SECTIONS}, {chunks_sql(120, 'sections')} SELECT * FROM chunks")
def _(spark, sf):
    return textify.chunk_wrap(md_documents(spark, sf), max_chars=120)


@query(
    "chunk_provenance",
    f"""WITH {SECTIONS} SELECT doc_id, section_no, 'Fonte: docs/'||doc_id||'.md'||chr(10)||'Camada/documentacao: '
        ||'documentation_silver'||chr(10)||chr(10)||section AS text FROM sections""",
)
def _(spark, sf):
    found = textify.chunk_sections(md_documents(spark, sf))
    source = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".md"))
    text = textify.chunk_provenance(source, F.lit("documentation_silver"), F.col("section"))
    return found.select("doc_id", "section_no", text.alias("text"))


@query("fold_text", f"WITH {QUESTIONS} SELECT question_id, {FOLDED.format(x='question')} AS folded FROM questions")
def _(spark, sf):
    return questions(spark, sf).select("question_id", t.fold_text(F.col("question")).alias("folded"))


@query("question_intent", f"WITH {ASKED} SELECT question_id, intent FROM asked")
def _(spark, sf):
    return routing.with_intent(questions(spark, sf)).select("question_id", "intent")


@query("intent_domain_route", f"WITH {ASKED}, {ROUTES} SELECT question_id, intent, domain FROM asked JOIN routes USING (intent)")
def _(spark, sf):
    asked = routing.with_intent(questions(spark, sf)).select("question_id", "intent")
    return routing.intent_domain_route(asked)


MARKER = """((intent = 'identity' AND contains(text, '## Quem e o assistente'))
  OR (intent = 'models_metrics' AND (contains(text, '## Modelos treinados') OR contains(text, '## Metricas utilizadas')))
  OR (intent = 'preprocessing' AND contains(text, '## Pre-processamento dos dados')))"""


@query(
    "marker_filter",
    f"""WITH {CORPUS}, intents(intent) AS (VALUES ('identity'), ('models_metrics'), ('preprocessing'), ('cost'))
        SELECT id, intent FROM corpus, intents WHERE {MARKER}""",
)
def _(spark, sf):
    names = F.explode(F.array(*[F.lit(x) for x in ("identity", "models_metrics", "preprocessing", "cost")]))
    hits = corpus(spark, sf).select("id", "text", names.alias("intent"))
    return routing.marker_filter(hits).select("id", "intent")


ANSWERS = {
    "identity": "Sou o assistente de dados.",
    "models_metrics": "Quatro modelos, cinco metricas.",
    "preprocessing": "Limpeza, agregacao e preparo das features.",
}
FAQ = f"""CASE WHEN contains(f,'quem e voce') OR contains(f,'quem voce e') THEN '{ANSWERS["identity"]}'
  WHEN (contains(f,'modelo treinado') OR contains(f,'modelos treinados') OR contains(f,'modelo foi treinado')
    OR contains(f,'modelos foram treinados')) AND contains(f,'metrica') THEN '{ANSWERS["models_metrics"]}'
  WHEN contains(f,'pre processamento') OR contains(f,'pre-processamento') THEN '{ANSWERS["preprocessing"]}' ELSE '' END"""


@query("faq_answer", f"WITH {ASKED} SELECT question_id, {FAQ} AS answer FROM asked")
def _(spark, sf):
    folded = t.fold_text(F.col("question"))
    return questions(spark, sf).select("question_id", t.faq_answer(folded, ANSWERS, FAQ_RULES).alias("answer"))


@query(
    "expose_sources",
    f"WITH {ASKED} SELECT question_id, NOT (contains(f,'quem e voce') OR contains(f,'quem voce e')) AS exposed FROM asked",
)
def _(spark, sf):
    return questions(spark, sf).select("question_id", t.expose_sources(t.fold_text(F.col("question"))).alias("exposed"))


CONTEXT = """replace(replace(replace({x}, 'Acesso fora do horario normal: False.', 'Nao houve acesso fora do horario normal.'),
  'Acesso fora do horario normal: True.', 'Houve acesso fora do horario normal.'),
  'Nível de risco: normal.', 'Nivel de risco: normal.')"""


@query("normalize_context", f"WITH {marts_sql()}, {SENTENCES} SELECT domain, {CONTEXT.format(x='text')} AS text FROM sentences")
def _(spark, sf):
    parts = [
        textify.textify_rows(mart, domain).select("domain", t.normalize_context(F.col("text")).alias("text"))
        for domain, mart in marts(spark, sf).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "clean_answer_text",
    f"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split_regex(trim(replace(text||chr(10)||'  '||chr(10)
        ||'{GENERIC_PHRASES[2]}'||' fim  ', '{GENERIC_PHRASES[2]}', ''), E' \\t\\n\\r'), E'\\r\\n|[\\n\\r\\x0b\\x0c]'),
        lambda s: rtrim(s, E' \\t\\n\\r')), lambda s: s <> ''), chr(10)) AS text FROM documents""",
)
def _(spark, sf):
    noisy = F.concat(F.col("text"), F.lit("\n  \n" + GENERIC_PHRASES[2] + " fim  "))
    return table(spark, sf, "documents").select("doc_id", t.clean_answer_text(noisy).alias("text"))


def layer_documents(spark, sf):
    """The generated headings text as documents of two layers and of the project."""
    part = F.col("doc_id") % 3
    domain = (
        F.when(part == 0, "documentation_bronze").when(part == 1, "documentation_silver").otherwise("documentation_project")
    )
    source = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".md"))
    return md_documents(spark, sf).select("doc_id", domain.alias("domain"), source.alias("source"), "text")


CORPUS_TEXTS = f"""{marts_sql()}, {SENTENCES}, {SECTIONS}, {chunks_sql(3000, 'sections')},
tails AS (SELECT domain, text FROM sentences),
layers AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 'documentation_bronze' WHEN doc_id % 3 = 1 THEN 'documentation_silver'
  ELSE 'documentation_project' END AS domain FROM chunks)
SELECT domain, text FROM tails UNION ALL
SELECT domain, 'Fonte: docs/'||doc_id||'.md'||chr(10)||CASE WHEN domain = 'documentation_project'
  THEN 'Documentacao: Plataforma' ELSE 'Camada/documentacao: '||domain END||chr(10)||chr(10)||chunk FROM layers"""


@query("build_corpus", f"WITH RECURSIVE {CORPUS_TEXTS}")
def _(spark, sf):
    documents = layer_documents(spark, sf)
    return corpus_plan.corpus_texts(marts(spark, sf), documents, "Plataforma").select("domain", "text")
