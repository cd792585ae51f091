"""Column expressions for question folding, routing rules and text clean-up."""

from __future__ import annotations

import sys
import unicodedata
from string import Formatter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from logquarry.fixed_values import (
    CONTEXT_REPLACEMENTS, DEFAULT_INTENT, FAQ_RULES, GENERIC_PHRASES, HIDDEN_SOURCE_TERMS, INTENT_RULES,
    WHITESPACE,
)
from logquarry.functions.columns import strip


def _latin_folding() -> dict[str, str]:
    """Accented Latin letters and the single letter each decomposes to, found by rule."""
    table = {}
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]:
        kept = [c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)]
        if len(kept) == 1 and kept[0].isascii() and kept[0].isalpha():
            table[chr(code)] = kept[0]
    return table


LATIN_FOLDING = _latin_folding()
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def _combining_marks() -> dict[int, None]:
    return dict.fromkeys(code for code in range(sys.maxunicode + 1) if unicodedata.combining(chr(code)))


COMBINING_MARKS = _combining_marks()


@F.pandas_udf(StringType())
def _fold_any_script(texts: pd.Series) -> pd.Series:
    plain = texts.str.normalize("NFKD").str.translate(COMBINING_MARKS)
    return plain.str.lower().str.split().str.join(" ")


def fill(template: str, **columns: Column) -> Column:
    """The template with each `{name}` replaced by the text of that column; a missing value reads `nan`."""
    parts = []
    for text, name, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name:
            parts.append(F.coalesce(columns[name].cast("string"), F.lit("nan")))
    return F.concat(*parts)


def _without_accents(column: Column) -> Column:
    return F.translate(column, "".join(LATIN_FOLDING), "".join(LATIN_FOLDING.values()))


def fold_latin(column: Column) -> Column:
    """Drop accents, lower-case, collapse white space: exact for ASCII and accented Latin letters."""
    return strip(F.regexp_replace(F.lower(_without_accents(column)), r"[\s\x0b\x1c-\x1f]+", " "))


def fold_text(column: Column) -> Column:
    """As `fold_latin` for every script: only texts with other characters are sent to Python."""
    plain = _without_accents(column)
    only_ascii_left = F.octet_length(plain) == F.char_length(plain)
    other = _fold_any_script(F.when(~only_ascii_left, column))
    return F.when(only_ascii_left, fold_latin(column)).otherwise(other)


def contains_any(column: Column, terms) -> Column:
    found = F.lit(False)
    for term in terms:
        found = found | column.contains(term)
    return found


def question_intent(folded: Column, rules=INTENT_RULES, default: str = DEFAULT_INTENT) -> Column:
    """Name of the first rule with a term in the folded question."""
    result = None
    for intent, terms in rules:
        matches = contains_any(folded, terms)
        result = F.when(matches, intent) if result is None else result.when(matches, intent)
    return result.otherwise(default)


def faq_answer(folded: Column, answers: dict[str, str], rules=FAQ_RULES) -> Column:
    """The caller's fixed answer for the first rule that matches the folded question, else an empty text."""
    result = F.when(F.lit(False), "")
    for key, groups in rules:
        matches = F.lit(True)
        for terms in groups:
            matches = matches & contains_any(folded, terms)
        result = result.when(matches, F.lit(answers.get(key, "")))
    return result.otherwise("")


def expose_sources(folded: Column, hidden=HIDDEN_SOURCE_TERMS) -> Column:
    return ~contains_any(folded, hidden)


def normalize_context(column: Column, replacements=CONTEXT_REPLACEMENTS) -> Column:
    """Literal replacements in order; NULL becomes an empty text."""
    text = F.coalesce(column, F.lit(""))
    for old, new in replacements:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def clean_answer_text(column: Column, phrases=GENERIC_PHRASES) -> Column:
    """Remove the phrases, cut white space at line ends, drop blank lines."""
    text = column
    for phrase in phrases:
        text = F.replace(text, F.lit(phrase), F.lit(""))
    lines = F.transform(F.split(strip(text), LINE_END), lambda line: F.rtrim(line, F.lit(WHITESPACE)))
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")
