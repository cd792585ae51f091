"""One query per operator over the driver's tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.llm import bpe, chat, fingerprints, language, licenses, lines, mixing, negatives, packing, sharding, simhash, spelling, vectors
from logquarry.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from logquarry.session import shared_dir


@query("op1_piecewise_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


@query("op2_prefix_target_examples")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], turns.schema)
    return chat.read_back(chat.render_examples(chat.format_turns(turns.unionByName(added))))


@query("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


MIX_ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{mixing.WORDS}')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS hash
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
capped AS (
  SELECT *, row_number() OVER (ORDER BY 2 * source_size / weight, source NULLS LAST) AS place,
         1.5::DOUBLE * sum(source_size) OVER () AS budget,
         sum(weight) OVER () AS weights FROM sources),
levels AS (
  SELECT *, (budget - coalesce(sum(2 * source_size) OVER before, 0)) / (weights - coalesce(sum(weight) OVER before, 0)) AS level
  FROM capped WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, weight,
         least(CAST(2 * source_size AS DOUBLE), weight * (SELECT arg_min(level, place) FROM levels WHERE level * weight < 2 * source_size)) AS target
  FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(least(floor(target / source_size), 2) AS BIGINT) ELSE 0 END AS repeats FROM targets),
running AS (
  SELECT d.*, source_size, target, repeats, target - repeats * source_size AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY hash) AS through
  FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (repeats + CASE WHEN through <= rest OR (through - size < rest AND 2 * (rest - through + size) >= size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM running"""


@query("op4_mix_to_weights", MIX_ORACLE)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query("op5_byte_pair_round_trip")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@query("op6_fuzzy_line_groups")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_groups(table(spark, sf_dir, "documents")).drop("doc_key")


@query("op7_rotated_code_links")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op8_golay_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_license_compression")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_blocks(table(spark, sf_dir, "documents"))


@query("op10_language_evidence")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and all web pages, with likelihoods fitted on a sample of the documents."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language.fit(docs)
    none = F.lit(None)
    found = ["language", "language_by_text", "language_score", "language_accepted"]
    documents = language.document_languages(docs, model).select(
        "doc_id", none.cast("long").alias("page_id"), F.col("lang").alias("declared"), *found
    )
    web = language.page_languages(pages, model).select(none.cast("long").alias("doc_id"), "page_id", "declared", *found)
    return documents.unionByName(web)


NEGATIVES_ORACLE = f"""
WITH v AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor({negatives.SCALE} * CAST(x AS DOUBLE))) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.vector) = len(b.vector) WHERE a.vec_id % {negatives.EVERY} = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {negatives.POSITIVES})
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND {negatives.WINDOW[0]} * p.positive_score <= 100 * n.score AND 100 * n.score <= {negatives.WINDOW[1]} * p.positive_score
QUALIFY rank <= {negatives.NEGATIVES}"""


@query("op11_hyperplane_tree_negatives", NEGATIVES_ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


@query("op12_two_pass_shards")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = shared_dir(spark, f"shards-{uuid4().hex}")
    sharding.write_shards(docs, path)
    return sharding.shard_report(sharding.read_shards(spark, path, docs.schema))


SPELLING_ORACLE = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS of FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) t(i))),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{spelling.RUNS}')) AS run FROM documents) WHERE len(run) >= {spelling.LEAST_LENGTH}),
counted AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(octet_length(key)), lambda i: CAST(('0x' || hex(key[i + 1 : i + 1])) AS BIGINT))),
    lambda c, b: xor(c >> 8, of[xor(c, b) % 256 + 1]))) AS h
  FROM (SELECT run, times, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS key FROM counted), crc_table),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % {spelling.DAMAGED} = 0 THEN left(run, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word FROM hashed)
  WHERE len(word) >= {spelling.LEAST_LENGTH} GROUP BY word HAVING sum(times) >= {spelling.LEAST_COUNT}),
gaps AS (SELECT DISTINCT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, len(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, (-other_n, encode(other))) AS best FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {spelling.RATIO} * n THEN best END AS form,
         CASE WHEN best_n >= {spelling.RATIO} * n THEN best_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
steps AS (
  SELECT word, word AS here, 0 AS step FROM forms
  UNION ALL SELECT s.word, f.form, step + 1 FROM steps s JOIN forms f ON f.word = s.here WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM forms f JOIN (SELECT word, arg_max(here, step) AS root FROM steps GROUP BY word) s ON f.word = s.word"""


@query("op13_composed_spelling_variants", SPELLING_ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))
