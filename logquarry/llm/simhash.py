"""SimHash near-duplicates found by Golay codes.

A 64-bit fingerprint is cut into three segments of at most 23 bits. Among 3 differing bits at most one segment has two
or more, so two fingerprints that link agree up to one bit in at least two segments. The perfect Golay code has exactly
one codeword within 3 bits of any 23-bit word; if two words differ in one bit, the codeword of the one lies within 4 bits
of the other. So every fingerprint is filed under the codewords of its segment pairs and looks under all codewords within
4 bits, six or one per segment: whoever meets is compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import connected_components, small_side, stored, thrifty
from logquarry.llm.links import forest

SHINGLE_WORDS = 3
MOST_BITS = 3
SEED = 42
# Bits of the segments, from the lowest.
SEGMENTS = (22, 21, 21)
PAIRS = ((0, 1), (0, 2), (1, 2))
# Generator polynomial of the binary Golay code of length 23: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
# Fingerprints filed under one key and compared by one task at a time; fuller keys are split.
BLOCK = 2048
# Fingerprints that one task files and looks up.
EXPANDED = 5000
# Pairs compared at once.
CHUNK = 2_000_000
# Name that no column of documents has.
MARK = "simhash removed fingerprint"


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if more than half of the shingles' hashes have it; 0 for a text without words."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    firsts, lasts = starts[: len(parts) - width + 1], ends[width - 1 :]
    for at in range(0, len(firsts), 65_536):
        spans = zip(firsts[at : at + 65_536].tolist(), lasts[at : at + 65_536].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(firsts), bitorder="little").tobytes(), "little")


def fingerprint_of(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a whole text as a signed 64-bit number."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(x, words) for x in texts], dtype=np.uint64).view(np.int64))

    return F.pandas_udf(thrifty(of), "long")(text.cast("string"))


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, fp): the fingerprint of every whole text."""
    return docs.select(F.col("doc_id").alias("doc_id"), fingerprint_of(F.col("text"), words).alias("fp"))


def _digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator; equal remainders mean that the words differ by a codeword."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


def error_patterns() -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome, the patterns of up to 4 bits that have it (0-padded to 6, the lightest first), and how many."""
    bits = 1 << np.arange(23, dtype=np.int64)
    patterns = [np.zeros(1, dtype=np.int64)]
    for _ in range(4):
        wider = (patterns[-1][:, None] | bits[None, :]).ravel()
        wider = np.unique(wider)
        patterns.append(wider[np.bitwise_count(wider) == len(patterns)])
    every = np.concatenate(patterns)
    found = syndromes(every)
    order = np.argsort(found, kind="stable")
    every, found = every[order], found[order]
    counts = np.bincount(found, minlength=2048)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    table = np.zeros((2048, 6), dtype=np.int64)
    table[found, np.arange(len(found)) - first[found]] = every
    return table, counts


def segment_codes(fps: np.ndarray, table: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per segment: codeword indices within 4 bits (the nearest codeword first) and which of the six places are used."""
    result, shift = [], 0
    for size in SEGMENTS:
        words = (fps >> np.uint64(shift)).astype(np.int64) & ((1 << size) - 1)
        shift += size
        found = syndromes(words)
        # The code is systematic up to order: a codeword is known by its upper 12 bits.
        result.append(((words[:, None] ^ table[found]) >> 11, np.arange(6)[None, :] < counts[found][:, None]))
    return result


def keys_of(fps: np.ndarray, table: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arrays (key, fp, probe): the three keys each fingerprint is filed under, and all it looks under."""
    codes = segment_codes(fps, table, counts)
    keys, owners, probes = [], [], []
    for number, (a, b) in enumerate(PAIRS):
        (left, left_used), (right, right_used) = codes[a], codes[b]
        base = number << 24
        keys.append(base | left[:, 0] << 12 | right[:, 0])
        owners.append(fps)
        probes.append(np.zeros(len(fps), dtype=bool))
        used = left_used[:, :, None] & right_used[:, None, :]
        grid = base | left[:, :, None] << 12 | right[:, None, :]
        keys.append(grid[used])
        owners.append(np.repeat(fps, used.sum(axis=(1, 2))))
        probes.append(np.ones(len(keys[-1]), dtype=bool))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(probes)


def _keyed(fps: DataFrame, probes: bool | None = None) -> DataFrame:
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, counts = error_patterns()
        for batch in batches:
            values = batch["fp"].to_numpy().view(np.uint64)
            for at in range(0, len(values), 1000):
                key, fp, probe = keys_of(values[at : at + 1000], table, counts)
                chosen = slice(None) if probes is None else probe == probes
                yield pd.DataFrame({"key": key[chosen], "fp": fp.view(np.int64)[chosen], "probe": probe[chosen]})

    return fps.mapInPandas(thrifty(of), "key long, fp long, probe boolean")


def fingerprint_links(fps: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Rows (src, dst) that connect exactly the distinct fingerprints (column fp) at `most_bits` bits or fewer.

    `most_bits` may be up to 3. A key under which many fingerprints are filed is split into blocks, and whoever looks
    there looks into each. Rows of a key stream by, those filed first; what a task finds leaves it as a forest.
    """
    if not 0 <= most_bits <= MOST_BITS:
        raise ValueError("Three segments find fingerprints up to 3 bits apart")
    filed = _keyed(fps, probes=False).groupBy("key").count().where(F.col("count") > BLOCK)
    full = stored(filed.select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "simhash-full-keys")
    keyed = _keyed(fps).join(small_side(full), "key", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.array(F.pmod(F.xxhash64("fp"), blocks).cast("int"))
    keyed = keyed.withColumn("block", F.explode(F.when(F.col("probe"), F.sequence(F.lit(0), blocks - 1)).otherwise(own)))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((0, 3), dtype=np.int64)  # key, block and fp filed under the last key so far
        for batch in batches:
            key, block, fp = (batch[c].to_numpy().astype(np.int64) for c in ("key", "block", "fp"))
            probe = batch["probe"].to_numpy().astype(bool)
            key, block, fp = (np.concatenate([held[:, i], x]) for i, x in enumerate((key, block, fp)))
            probe = np.concatenate([np.zeros(len(held), dtype=bool), probe])
            if not len(key):
                continue
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (block[1:] != block[:-1])])
            group = np.cumsum(new) - 1
            starts = np.flatnonzero(new)
            sizes = np.bincount(group, weights=~probe).astype(np.int64)
            last = (group == group[-1]) & ~probe
            held = np.stack([key[last], block[last], fp[last]], axis=1)
            looking = np.flatnonzero(probe)
            looking = looking[sizes[group[looking]] > 0]
            # Each probe meets the `sizes` rows at the start of its group.
            many = sizes[group[looking]]
            cuts = np.searchsorted(np.cumsum(many), np.arange(CHUNK, int(many.sum()) + CHUNK, CHUNK))
            lefts, rights = [], []
            for at, to in zip([0, *(cuts + 1)], [*(cuts + 1), len(looking)]):
                part, each = looking[at:to], many[at:to]
                if not len(part):
                    continue
                a = np.repeat(fp[part], each)
                inside = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
                b = fp[np.repeat(starts[group[part]], each) + inside]
                near = (a < b) & (np.bitwise_count((a ^ b).view(np.uint64)) <= most_bits)
                if near.any():
                    x, y = forest(a[near], b[near])
                    lefts.append(x[x != y])
                    rights.append(y[x != y])
            if lefts:
                yield pd.DataFrame({"src": np.concatenate(lefts), "dst": np.concatenate(rights)})

    ordered = keyed.select("key", "block", "probe", "fp").repartition("key", "block")
    return ordered.sortWithinPartitions("key", "block", "probe", "fp").mapInPandas(thrifty(compare), "src long, dst long")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id
    reachable over fingerprints at most `most_bits` bits apart, itself included.

    Null, empty and blank texts have fingerprint 0, which links like any other. Rows with a null doc_id take part, but
    only ids that are not null name a component; other columns are ignored; an empty table gives no rows.
    """
    rows = stored(fingerprints(docs, words), "simhash-fingerprints")
    different = stored(rows.select("fp").distinct(), "simhash-different")
    # Every fingerprint becomes some 80 rows: as many tasks as these ask for, however small the fingerprints are.
    links = fingerprint_links(different.repartition(max(1, -(-different.count() // EXPANDED)), "fp"), most_bits)
    groups = connected_components(links, "simhash-components").select(F.col("id").alias("fp"), F.col("component").alias("class"))
    classed = stored(rows.join(groups, "fp", "left").withColumn("class", F.coalesce("class", "fp")), "simhash-classes")
    # Only classes of several rows have another one first; few, or joined as tables that can be split at a hot class.
    smallest = classed.groupBy("class").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    found = classed.join(small_side(stored(smallest.select("class", "first"), "simhash-firsts")), "class", "left")
    return found.select("doc_id", _digits(F.col("fp")).alias("fingerprint"), F.coalesce("first", "doc_id").alias("component_id"))


def without_near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """`docs` with one document of each component, the one with the smallest doc_id; all columns kept.

    Rows go by (doc_id, fingerprint), so an id that occurs with several texts leaves no component empty. Rows equal in
    both stay or go together, texts of the smallest id all stay, and so do rows without a doc_id.
    """
    found = near_duplicates(docs.select("doc_id", "text"), words, most_bits)
    goes = F.col("doc_id") != F.col("component_id")
    by_id = found.groupBy("doc_id").agg(F.max(goes).alias("some"), F.min(goes).alias("all"))
    gone = stored(by_id.where("some").select("doc_id", "all"), "simhash-removed")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    left = docs.join(small_side(gone.select("doc_id")), "doc_id", "left_anti").select(*columns)
    # Ids of which some texts stay: only their texts are looked at again.
    split = gone.where("NOT all").select("doc_id")
    if split.isEmpty():
        return left
    pairs = found.where(goes).join(split, "doc_id", "left_semi").select("doc_id", F.col("fingerprint").alias(MARK)).distinct()
    marked = docs.join(small_side(split), "doc_id", "left_semi").withColumn(MARK, _digits(fingerprint_of(F.col("text"), words)))
    return left.unionByName(marked.join(pairs, ["doc_id", MARK], "left_anti").select(*columns))
