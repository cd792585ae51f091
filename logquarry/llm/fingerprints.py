"""Document fingerprints by context-triggered piecewise hashing.

A hash over the last seven bytes is rolled over the UTF-8 text; where it ends in enough zero bits a piece ends. The
fingerprint is `k:A:B`: pieces ending at k and at k + 1 zero bits, one base-64 character per piece hash. k is the
smallest level with at most 64 pieces, so block sizes double from level to level and whole texts are covered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import stored

WINDOW = 7
MAX_PIECES = 64
# Signatures that share no run of this many characters count as unlike.
COMMON_RUN = 7
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
# A random value per byte, from a fixed seed, and the odd multiplier of the rolling hash.
BYTE_VALUES = np.random.default_rng(20_240_601).integers(0, 2**64, 256, dtype=np.uint64)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
# Rows of one ordered range at least; there are at most four ranges per shuffle partition.
RANGE_ROWS = 1_000


def zero_bits(data: bytes) -> np.ndarray:
    """Per byte position, the trailing zero bits of the mixed hash of the (up to seven) bytes that end there."""
    values = BYTE_VALUES[np.frombuffer(data, dtype=np.uint8)]
    rolled = values.copy()
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for back in range(1, min(WINDOW, len(values))):
            power = power * MULTIPLIER
            rolled[back:] += values[:-back] * power
        rolled ^= rolled >> np.uint64(31)
        rolled *= np.uint64(0xBF58476D1CE4E5B9)
        rolled ^= rolled >> np.uint64(33)
        below = (rolled & (~rolled + np.uint64(1))) - np.uint64(1)
    return np.bitwise_count(below).astype(np.int64)


def _signature(data: bytes, ends: np.ndarray) -> str:
    start, letters = 0, []
    for end in ends.tolist():
        letters.append(ALPHABET[xxhash.xxh64_intdigest(data[start:end]) & 63])
        start = end
    if start < len(data):
        letters.append(ALPHABET[xxhash.xxh64_intdigest(data[start:]) & 63])
    return "".join(letters)


def fingerprint(text: str | None) -> str:
    """`level:pieces at level:pieces at level + 1`; a null or empty text gives `0::`."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return "0::"
    zeros = zero_bits(data)
    at_least = np.bincount(zeros, minlength=66)[::-1].cumsum()[::-1]
    # Triggers at level k are those with k or more zero bits; one piece more may follow the last.
    level = int(np.argmax(at_least < MAX_PIECES)) if at_least[0] > MAX_PIECES else 0
    ends = np.flatnonzero(zeros >= level) + 1
    coarse = ends[zeros[ends - 1] >= level + 1]
    return f"{level}:{_signature(data, ends)}:{_signature(data, coarse)}"


def _common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, 1 bit per character of `a`."""
    where: dict[str, int] = {}
    for i, letter in enumerate(a):
        where[letter] = where.get(letter, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for letter in b:
        hit = row & where.get(letter, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _signature_likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    run = min(COMMON_RUN, len(a), len(b))
    if not run:
        return 0.0
    runs = {a[i : i + run] for i in range(len(a) - run + 1)}
    if not any(b[i : i + run] in runs for i in range(len(b) - run + 1)):
        return 0.0
    # Edit distance of insertions and deletions is what the common subsequence leaves over.
    return 2 * _common_length(a, b) / (len(a) + len(b))


def likeness(left: str, right: str) -> float:
    """1 minus the scaled edit distance of the signatures at equal block sizes; 0 if no block sizes are equal."""
    if left == right:
        return 1.0
    level_a, fine_a, coarse_a = left.split(":")
    level_b, fine_b, coarse_b = right.split(":")
    step = int(level_a) - int(level_b)
    if step == 0:
        # Coarse signatures of few pieces match by chance; they only speak where the fine ones are like as well.
        fine = _signature_likeness(fine_a, fine_b)
        return max(fine, _signature_likeness(coarse_a, coarse_b)) if len(coarse_a) > COMMON_RUN < len(coarse_b) else fine
    if step == 1:
        return _signature_likeness(fine_a, coarse_b)
    if step == -1:
        return _signature_likeness(coarse_a, fine_b)
    return 0.0


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of every whole text; null texts count as empty."""

    def of(texts: pd.Series) -> pd.Series:
        return texts.map(fingerprint, na_action=None)

    return docs.withColumn(out, F.pandas_udf(of, "string")(F.coalesce(F.col(text), F.lit(""))))


def neighbour_stream(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows (range_no, doc_id, text, own) so that each range, in descending (doc_id, text), ends with its follower.

    Ranges are cut at quantiles of doc_id; the top of each range is sent to the range above it as a row that is not
    `own`, and the overall top to the lowest range. So only whole texts move, once, and no task sees the whole order.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = docs.count()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(n // range_rows, 4 * partitions))
    splits = [float("-inf"), float("inf")]
    if ranges > 1:
        cuts = ids.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", [i / ranges for i in range(1, ranges)], 0.2 / ranges)
        splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) > 2:
        cutter = Bucketizer(splits=splits, inputCol="_order", outputCol="_range", handleInvalid="keep")
        keyed = cutter.transform(ids.withColumn("_order", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))))
    else:
        keyed = ids.withColumn("_range", F.lit(0.0))
    keyed = keyed.select(F.col("_range").cast("int").alias("range_no"), "doc_id", "text")
    # Null ids come last in descending order, so they belong to the lowest range.
    tops = stored(keyed.groupBy("range_no").agg(F.max("doc_id").alias("top")), "range-tops")
    heads = tops.orderBy("range_no").collect()  # one row per range
    above = {row["range_no"]: heads[(i + 1) % len(heads)]["range_no"] for i, row in enumerate(heads)}
    if not heads:
        return keyed.withColumn("own", F.lit(True)).withColumn("part", F.lit(0))
    links = docs.sparkSession.createDataFrame([(r["range_no"], r["top"], above[r["range_no"]]) for r in heads], "range_no int, top long, above int")
    marked = keyed.join(F.broadcast(links), "range_no")
    is_top = F.col("doc_id").eqNullSafe(F.col("top"))
    own = F.struct(F.col("range_no").alias("part"), F.lit(True).alias("own"))
    copy = F.struct(F.col("above").alias("part"), F.lit(False).alias("own"))
    places = F.explode(F.when(is_top, F.array(own, copy)).otherwise(F.array(own)))
    return marked.withColumn("place", places).select("place.part", "place.own", "doc_id", "text")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text, of its edited text, and their likeness, next to that of the following document.

    The edited text has its last floor(n/3) code points replaced by the first as many (or all) of the next document in
    descending doc_id, the first following the last. Null texts are empty, null ids come last, equal ids are ordered by
    text, rows that are equal are all kept; a single document follows itself; an empty table gives no rows. Columns
    besides doc_id and text are ignored.
    """
    stream = neighbour_stream(docs)

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        held = None
        names = [f.split()[0] for f in schema.split(", ")]
        for batch in batches:
            rows = []
            for part, own, doc_id, text in zip(batch["part"], batch["own"], batch["doc_id"], batch["text"]):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                text = "" if text is None else text
                mark = fingerprint(text)
                if held is not None and held[0] == part and held[1]:
                    _, _, before_id, before, before_mark = held
                    cut = len(before) // 3
                    edited = before[: len(before) - cut] + text[:cut]
                    edited_mark = fingerprint(edited)
                    rows.append((
                        before_id, len(before), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        before_mark, edited_mark, likeness(before_mark, edited_mark), likeness(before_mark, mark),
                    ))
                held = (part, own, doc_id, text, mark)
            if rows:
                out = pd.DataFrame(rows, columns=names)
                out["doc_id"] = pd.array([r[0] for r in rows], dtype="Int64")
                yield out

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    order = [F.col("part"), F.col("own").desc(), F.desc_nulls_last("doc_id"), F.asc_nulls_first("text")]
    return stream.repartition("part").sortWithinPartitions(*order).mapInPandas(pairs, schema)
