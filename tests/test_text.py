import re
import unicodedata
from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from logquarry.fixed_values import GENERIC_PHRASES
from logquarry.functions import text as t
from logquarry.operators import routing, textify

QUIET = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def column(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    return [r[1] for r in sorted(rows(df.select("i", expression(F.col("x")))))]


def folded(text):
    letters = filter(lambda c: unicodedata.combining(c) == 0, unicodedata.normalize("NFKD", text))
    return re.sub(r"\s+", " ", "".join(letters).lower().strip())


def column(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    return [r[1] for r in sorted(rows(df.select("i", expression(F.col("x")))))]


def folded(text):
    kept = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return " ".join(kept.lower().split())


def test_fold_text_over_all_of_latin_and_more(spark):
    texts = [f"A {chr(c)} b\t{chr(c)}" for c in [*range(1, 0x250), *range(0x300, 0x370), *range(0x1E00, 0x2100)]]
    texts += ["  Quem É  você?\n", "ＣＵＳＴＯ", "ﬁm", "한국어 É", "ǅ", "½", "", "𝐂𝐮𝐬𝐭𝐨"]
    assert column(spark, texts, t.fold_text) == [folded(x) for x in texts]


@QUIET
@given(st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_fold_text_on_any_text(spark, texts):
    assert column(spark, texts, t.fold_text) == [folded(x) for x in texts]


def test_fold_text_keeps_null(spark):
    assert column(spark, ["x", None], t.fold_text) == ["x", None]


@pytest.mark.parametrize(
    "question, intent",
    [
        ("Quem é você?", "identity"),
        ("Quais modelos foram treinados na camada gold?", "models_metrics"),
        ("Explique o PRÉ-PROCESSAMENTO da bronze", "preprocessing"),
        ("Como é a ingestão?", "documentation_bronze"),
        ("silver e gold", "documentation_silver"),
        ("camada gold", "documentation_gold"),
        ("o processo", "documentation_pipeline"),
        ("risco de custo", "security"),
        ("custo e desempenho", "cost"),
        ("Tráfego de usuários únicos", "performance"),
        ("bom dia", "general"),
        ("", "general"),
    ],
)
def test_intents(spark, question, intent):
    assert column(spark, [question], lambda x: t.question_intent(t.fold_text(x))) == [intent]


def test_every_intent_has_its_domains(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(["gold", "pipeline", "custo", "quem e voce"])], "question_id int, question string")
    asked = routing.with_intent(df)
    routed = routing.intent_domain_route(asked)
    assert dict(rows(routed.groupBy("question_id").count())) == {0: 3, 1: 5, 3: 1}
    assert [r["question_id"] for r in routing.without_route(asked).collect()] == [2]


def test_faq_needs_every_group_of_terms(spark):
    answers = {"identity": "A", "models_metrics": "B", "preprocessing": "C"}
    questions = ["quem é você", "modelos treinados", "modelos treinados e métricas", "pré-processamento", "oi", "modelo foi treinado, metrica"]
    found = column(spark, questions, lambda x: t.faq_answer(t.fold_text(x), answers))
    assert found == ["A", "", "B", "C", "", "B"]
    hidden = column(spark, questions[:2], lambda x: t.expose_sources(t.fold_text(x)))
    assert hidden == [False, True]


def test_normalize_context(spark):
    texts = [
        "Acesso fora do horário normal: False. Nível de risco: normal.", "Acesso fora do horario normal: True.",
        "N" + "Ã" + "\xad" + "vel de risco: normal.", None, "x",
    ]
    assert column(spark, texts, t.normalize_context) == [
        "Nao houve acesso fora do horario normal. Nivel de risco: normal.", "Houve acesso fora do horario normal.",
        "Nivel de risco: normal.", "", "x",
    ]


def cleaned(text):
    body = reduce(lambda rest, phrase: "".join(rest.split(phrase)), GENERIC_PHRASES, text)
    return "\n".join(filter(None, map(str.rstrip, body.strip().splitlines())))


@QUIET
@given(st.lists(st.text(alphabet="ab \t\n\r\x0b\x1c\x85  ", max_size=30), min_size=1, max_size=20))
def test_clean_answer_text(spark, texts):
    texts = [x + GENERIC_PHRASES[3] + "\n  z" for x in texts]
    assert column(spark, texts, t.clean_answer_text) == [cleaned(x) for x in texts]


def sections(text):
    """Lines grouped into sections: a heading line, one to six # and white space, opens a new one."""
    groups = [""]
    for line in re.findall(r"[^\n]*\n|[^\n]+$", text.strip()):
        hashes = len(line) - len(line.lstrip("#"))
        if 1 <= hashes <= 6 and line[hashes:][:1].isspace():
            groups.append("")
        groups[-1] += line
    return groups


def pieces(part, limit):
    """A section in parts: it ends before the last line break among its first `limit` characters, or at the limit."""
    part = part.strip()
    if len(part) <= limit:
        return [part] if part else []
    breaks = [i for i in range(1, limit) if part[i] == "\n"]
    end = breaks[-1] if breaks else limit
    return [part[:end].strip(), *pieces(part[end:], limit)]


def chunks(text, limit):
    return [piece for section in sections(text) for piece in pieces(section, limit)]


def spark_chunks(spark, texts, limit):
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    found = [[] for _ in texts]
    for doc, _, chunk in sorted(rows(textify.chunk_wrap(df, "text", limit))):
        found[doc].append(chunk)
    return found


EDGES = [
    "", "   \n ", "no heading", "# only heading", "####### seven\ntext", "a\n# H1\nb\n## H2\n\nc", "#no space\nx",
    "x" * 25, "x" * 10, "x" * 11, "\n" + "y" * 12, "a\n" + "b" * 9 + "\n" + "c" * 30, "abcdefghi\n\n\n\njklmnop\n q",
    "é" * 23, "𝐂" * 23, "a\r\n# b\r\nc", "a\n#\x1cb\n#\u2003c", "a\n#", "#\nb", "# A\n# B\n# C", "x # not a line\ny",
]


@pytest.mark.parametrize("limit", [1, 2, 10, 3000])
def test_chunk_edges(spark, limit):
    assert spark_chunks(spark, EDGES, limit) == [chunks(x, limit) for x in EDGES]


@settings(QUIET, max_examples=40)
@given(st.lists(st.text(alphabet="ab# \n\t", max_size=120), min_size=1, max_size=20), st.integers(2, 30))
def test_chunks_follow_the_rule(spark, texts, limit):
    found = spark_chunks(spark, texts, limit)
    assert found == [chunks(x, limit) for x in texts]
    for text, parts in zip(texts, found):
        assert all(0 < len(p) <= limit for p in parts)
        assert "".join("".join(parts).split()) == "".join(text.split())


def test_long_text_without_line_breaks(spark):
    text = "z" * 1_000_000
    wide = "𝐂" * 10_000
    found = spark_chunks(spark, [text, wide], 3000)
    assert [len(c) for c in found[0]] == [3000] * 333 + [1000]
    assert [len(c) for c in found[1]] == [3000, 3000, 3000, 1000]


def test_unknown_domain_has_no_sentences(spark):
    df = spark.sql("SELECT DATE '2024-01-01' AS date, '10:00' AS hora_completa, 1L AS requests, 2L AS unique_users")
    assert textify.textify_rows(df, "other").count() == 0
    assert rows(textify.textify_rows(df, "performance").select("text")) == [
        ("Em 2024-01-01 as 10:00, o sistema processou 1 eventos de 2 usuarios unicos.",)
    ]


def test_provenance(spark):
    df = spark.createDataFrame([("s.md", "documentation_bronze", "body")], "s string, d string, c string")
    layer, project = rows(
        df.select(
            textify.chunk_provenance(F.col("s"), F.col("d"), F.col("c")),
            textify.chunk_provenance(F.col("s"), F.col("d"), F.col("c"), "Plataforma"),
        )
    )[0]
    assert layer == "Fonte: s.md\nCamada/documentacao: documentation_bronze\n\nbody"
    assert project == "Fonte: s.md\nDocumentacao: Plataforma\n\nbody"
