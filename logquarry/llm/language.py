"""Language identification by fusing evidence in a Bayesian way.

The likelihood of a text's letter trigrams is combined with what its markup declares, how reliable declarations turn out
to be, and a prior for its host, which is smoothed by its domain, its address suffix and the whole corpus. Declarations and
priors are learned from the texts' own posteriors by grouped sums; a row's prior leaves out the row itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import columns_of, small_side, stored, thrifty, whole_row

LANGUAGES = ("de", "en", "es", "fr")
# A further class for texts in none of them: every trigram is as likely as any other.
OTHER = "other"
GRAM_BUCKETS = 1 << 16
# Labelled texts per language that the likelihoods are fitted on, on average: a sample by hash.
SAMPLE_TEXTS = 2000
SMOOTHING = 0.5
# A text speaks like so many independent trigrams at most; neighbouring ones repeat each other.
FULL_EVIDENCE = 50
# Texts' worth of the parent's prior in a host's, a domain's or a suffix's.
PRIOR_STRENGTH = 10.0
LEAST_POSTERIOR = 0.5
# Trigrams scored at once.
CHUNK = 1_000_000


def letter_table() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def grams(text: str | None, letters: np.ndarray) -> np.ndarray:
    """Buckets of the trigrams of a lower-cased text in which each run of other characters is one space."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = np.where(letters[points], points, 32)
    points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])].astype(np.uint64)
    if len(points) < 3:
        return np.zeros(0, dtype=np.int64)
    mixed = (points[:-2] << np.uint64(42)) ^ (points[1:-1] << np.uint64(21)) ^ points[2:]
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(48)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """Log-likelihood per trigram bucket and language; the last column belongs to OTHER."""

    languages: tuple[str, ...]
    table: np.ndarray


def fit(labelled: DataFrame, languages: tuple[str, ...] = LANGUAGES, sample_texts: int = SAMPLE_TEXTS) -> LanguageModel:
    """Trigram likelihoods from rows (text, lang); what reaches the driver is a count per language and bucket.

    The sample is bounded by `sample_texts` different texts per language (on average, by hash of the text), each counted
    once however many copies there are; other labels and null texts are not used.
    """
    rows = labelled.where(F.col("lang").isin(*languages) & F.col("text").isNotNull()).select(F.col("lang").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text", F.lit("sample")))
    sizes = {r["lang"]: r["count"] for r in rows.select("lang", "hash").distinct().groupBy("lang").count().collect()}  # one row per language
    share = F.lit(0.0)
    for name, count in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, sample_texts / count))).otherwise(share)
    rows = rows.where(F.pmod("hash", F.lit(1_000_000)) < share * 1_000_000).select("lang", "text").distinct()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, sums = letter_table(), {}
        for batch in batches:
            for name, text in zip(batch["lang"], batch["text"]):
                found = np.bincount(grams(text, letters), minlength=GRAM_BUCKETS)
                sums[name] = sums[name] + found if name in sums else found
        for name, found in sums.items():
            bucket = np.flatnonzero(found)
            yield pd.DataFrame({"lang": name, "bucket": bucket, "n": found[bucket]})

    counts = rows.mapInPandas(thrifty(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.full((GRAM_BUCKETS, len(languages) + 1), -np.log(GRAM_BUCKETS))
    for place, name in enumerate(languages):
        of = counts[counts["lang"] == name]
        if len(of):
            seen = np.zeros(GRAM_BUCKETS)
            seen[of["bucket"].to_numpy()] = of["n"].to_numpy()
            table[:, place] = np.log((seen + SMOOTHING) / (seen.sum() + SMOOTHING * GRAM_BUCKETS))
    return LanguageModel(tuple(languages), table.astype(np.float32))


def shares(scores: np.ndarray) -> np.ndarray:
    """Posteriors of log scores, row by row."""
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def text_evidence(text: Column, model: LanguageModel, docs: DataFrame) -> Column:
    """Struct of a whole text's log-likelihoods per language and OTHER, scaled to the evidence it holds, and of the
    posteriors they give alone; null arrays if the text has no trigram of letters."""
    shared = docs.sparkSession.sparkContext.broadcast(model.table)  # buckets x languages numbers

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        for texts in batches:
            yield _evidence(texts, letters, shared.value)

    return F.pandas_udf(thrifty(of), "log array<double>, alone array<double>")(text)


def _evidence(texts: pd.Series, letters: np.ndarray, table: np.ndarray) -> pd.DataFrame:
    scores, alone = [], []
    for value in texts:
        found = grams(value, letters)
        total = np.zeros((1, table.shape[1]))
        for at in range(0, len(found), CHUNK):
            total += table[found[at : at + CHUNK]].sum(axis=0, dtype=np.float64)
        total *= FULL_EVIDENCE / (len(found) + FULL_EVIDENCE)
        scores.append(total[0] if len(found) else None)
        alone.append(shares(total)[0] if len(found) else None)
    return pd.DataFrame({"log": pd.Series(scores, dtype=object), "alone": pd.Series(alone, dtype=object)})


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Arrays as rows of numbers; null ones as zeros."""
    return np.array([np.zeros(width) if x is None else x for x in rows], dtype=np.float64).reshape(len(rows), width)


def fused(model: LanguageModel, docs: DataFrame, classes: tuple[str, ...], base: list[float], reliability: dict[str, list[float]]):
    """Function of a row's text, declaration, host and the counts and sums of its suffix, domain and host.

    The text's evidence is found once more in here: a task that took it from another function would need two workers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.table)
    log_said = {d: np.log(v) for d, v in reliability.items()}
    first = np.array(base)

    def fuse(log: pd.Series, alone: pd.Series, said: pd.Series, host: pd.Series, *sums: pd.Series) -> pd.DataFrame:
        k = len(classes)
        own = _matrix(alone, k) * host.notna().to_numpy()[:, None]
        counted = (own.sum(axis=1) > 0).astype(np.float64)[:, None]
        prior = np.broadcast_to(first, (len(log), k))
        for count, total in zip(sums[::2], sums[1::2]):
            n = count.fillna(0).to_numpy(dtype=np.float64)[:, None]
            there = (n > 0) * counted
            # The row itself is left out of what its host, domain and suffix say.
            rest = np.maximum(_matrix(total, k) - own * there, 0)
            prior = (rest + PRIOR_STRENGTH * prior) / (n - there + PRIOR_STRENGTH)
        evidence = np.array([log_said.get(d, np.zeros(k)) for d in said]).reshape(len(log), k)
        posterior = shares(_matrix(log, k) + evidence + np.log(prior))
        letters = log.notna().to_numpy()
        best, by_text = posterior.argmax(axis=1), _matrix(alone, k).argmax(axis=1)
        score = posterior.max(axis=1)
        names = np.array(classes, dtype=object)
        return pd.DataFrame({
            "language": np.where(letters, names[best], None), "score": score,
            "by_text": np.where(letters, names[by_text], None),
            "accepted": letters & (best < k - 1) & (score >= LEAST_POSTERIOR),
        })

    def of(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        for texts, *others in batches:
            evidence = _evidence(texts, letters, shared.value)
            yield fuse(evidence["log"], evidence["alone"], *others)

    return F.pandas_udf(thrifty(of), "language string, score double, by_text string, accepted boolean")


def identified(docs: DataFrame, model: LanguageModel, text: Column, declared: Column, host: Column, domain: Column, suffix: Column) -> DataFrame:
    """`docs` with language, language_score, language_by_text and language_accepted (columns of these names are replaced).

    `declared`, `host`, `domain` and `suffix` may be null, which is no evidence. A row is accepted if its text has
    letters, its best class is a language and that has a posterior of at least 0.5; without letters its language is
    null. Null and empty texts are not accepted. A host must determine its domain, a domain its suffix. Repeated rows are
    judged alike and each counts for its host; of equal posteriors the first class in order wins; an empty table gives
    no rows.
    """
    classes = (*model.languages, OTHER)
    known = F.lower(F.split(declared.cast("string"), "[-_]")[0])
    said = F.when(known == "", None).when(known.isin(*model.languages), known).when(known.isNotNull(), F.lit(OTHER))
    said_of, host_of = said.alias("_id_said"), host.cast("string").alias("_id_host")
    seen = docs.select(
        text_evidence(text, model, docs).alias("_id_text"), said_of, host_of,
        domain.cast("string").alias("_id_domain"), suffix.cast("string").alias("_id_suffix"),
    ).where(F.col("_id_text.log").isNotNull())
    names = [f"_id_p{i}" for i in range(len(classes))]
    # Sums of the texts' posteriors per host and declaration; all other levels are sums of these.
    per_host = stored(
        seen.groupBy("_id_host", "_id_domain", "_id_suffix", "_id_said").agg(
            F.count(F.lit(1)).alias("_id_n"), *[F.sum(F.col("_id_text.alone")[i]).alias(n) for i, n in enumerate(names)]
        ),
        "language-hosts",
    )
    sums = [F.sum(n).alias(n) for n in names]
    overall = per_host.agg(*sums).first()
    total = [(overall[n] or 0.0) + 1 for n in names]
    # P(declaration | class): one number per declaration and class, smoothed by one declaration each.
    said_sums = {r["_id_said"]: r for r in per_host.where("_id_said IS NOT NULL").groupBy("_id_said").agg(*sums).collect()}
    per_class = [sum(r[n] for r in said_sums.values()) + len(classes) for n in names]
    reliability = {d: [((said_sums[d][n] if d in said_sums else 0.0) + 1) / per_class[i] for i, n in enumerate(names)] for d in classes}

    levels = ("suffix", "domain", "host")

    def level(tag: str) -> DataFrame:
        there = per_host.where(F.col(f"_id_{tag}").isNotNull()).groupBy(f"_id_{tag}").agg(F.sum("_id_n").alias(f"_id_n_{tag}"), *sums)
        return there.select(f"_id_{tag}", f"_id_n_{tag}", F.array(*names).alias(f"_id_sum_{tag}"))

    hosts = per_host.select("_id_host", "_id_domain", "_id_suffix").where("_id_host IS NOT NULL").distinct()
    for tag in levels:
        hosts = hosts.join(level(tag), f"_id_{tag}", "left")
    hosts = stored(hosts.drop("_id_domain", "_id_suffix"), "language-priors")

    rows = docs.select(whole_row(docs), text.alias("_id_text"), said_of, host_of)
    joined = rows.join(small_side(hosts), "_id_host", "left")
    fuse = fused(model, docs, classes, [t / sum(total) for t in total], reliability)
    inputs = [c for tag in levels for c in (f"_id_n_{tag}", f"_id_sum_{tag}")]
    joined = joined.withColumn("_id_found", fuse("_id_text", "_id_said", "_id_host", *inputs))
    added = {"language": "language", "language_score": "score", "language_by_text": "by_text", "language_accepted": "accepted"}
    kept = columns_of(docs.drop(*added))
    return joined.select(*kept, *[F.col(f"_id_found.{v}").alias(k) for k, v in added.items()])


def page_evidence(pages: DataFrame) -> DataFrame:
    """Add _text, _declared, _host, _domain and _suffix, read from the columns html and url."""
    html, url = F.col("html").cast("string"), F.col("url").cast("string")
    body = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", " ")
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    host = F.when(host != "", host)
    declared = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    return pages.withColumns({
        "_text": body, "_declared": F.when(declared != "", declared), "_host": host,
        "_domain": F.substring_index(host, ".", -2),
        "_suffix": F.substring_index(host, ".", -1),
    })


def document_languages(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """Documents with their language; the source is the host, and nothing is declared."""
    none = F.lit(None).cast("string")
    model = model or fit(docs)
    return identified(docs, model, F.col("text").cast("string"), none, F.col("source"), none, none)


def page_languages(pages: DataFrame, model: LanguageModel) -> DataFrame:
    """Web pages with their language, from the text outside of tags, the declared language and the address.

    A column `declared` is added or replaced. A null or empty page has no language; a null or odd address is no evidence;
    repeated rows, ties and an empty table as in `identified`.
    """
    evidence = page_evidence(pages.select(whole_row(pages), F.col("html").alias("html"), F.col("url").alias("url")))
    found = identified(evidence, model, F.col("_text"), F.col("_declared"), F.col("_host"), F.col("_domain"), F.col("_suffix"))
    added = ["language", "language_score", "language_by_text", "language_accepted"]
    return found.select(*columns_of(pages.drop("declared", *added)), F.col("_declared").alias("declared"), *added)


def accepted_documents(docs: DataFrame) -> DataFrame:
    """`docs` without the rows whose language is not accepted, null and empty texts among them; columns as they were."""
    rows = docs.select(whole_row(docs), F.col("text").alias("text"), F.col("lang").alias("lang"), F.col("source").alias("source"))
    return document_languages(rows).where("language_accepted").select(*columns_of(docs))
