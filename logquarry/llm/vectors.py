"""Near-duplicate vectors by randomly rotated binary codes.

A unit vector o is rotated at random and stored as the signs of its coordinates, with the correction factor a = <o, o'>,
where o' is the unit vector of those signs. For another unit vector q, <q, o'> / a estimates <q, o> without bias; the
error is at most sqrt(1 - a^2) / a * sqrt(1 - <q, o>^2), and by 1 / sqrt(d - 1) of that per standard deviation. Pairs whose
upper bound reaches the threshold are recomputed exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import connected_components, small_side, stored
from logquarry.llm.links import forest

THRESHOLD = 0.98
SEED = 7
# Vectors of a block; two blocks meet in one task, so a vector is sent once per block of its label.
BLOCK = 8192
# Vectors compared with a block at once.
STEP = 512
# Candidate pairs recomputed at once.
CHUNK = 50_000
# Slack for the estimates' single precision.
SLACK = 1e-4


def rotation(d: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits of the rotated unit vectors, packed, and their correction factors."""
    turned = units @ rotation(units.shape[1]).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(units.shape[1])


def estimates(units: np.ndarray, codes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Unbiased estimates of the inner products of unit vectors with vectors known by code and factor."""
    d = units.shape[1]
    signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1
    turned = (units @ rotation(d).T / np.sqrt(d)).astype(np.float32)
    return (turned @ signs.T) / factors.astype(np.float32)[None, :]


def margins(factors: np.ndarray, d: int, threshold: float, deviations: float | None) -> np.ndarray:
    """How far the estimate of a product of at least `threshold` may fall short; None: at the very most."""
    share = 1.0 if deviations is None or d == 1 else min(1.0, deviations / np.sqrt(d - 1))
    spread = np.sqrt(np.maximum(0.0, 1 - factors**2)) / factors
    return spread * np.sqrt(max(0.0, 1 - threshold**2)) * share + SLACK


def coded(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add code (binary) and factor (double) to vectors that are neither null nor zero and have finite components."""

    def of(batches):
        for table in batches:
            values = table[vector].to_pylist()
            codes, factors = [None] * len(values), [None] * len(values)
            sizes = np.array([len(v) for v in values])
            for d in np.unique(sizes):
                places = np.flatnonzero(sizes == d)
                rows = np.array([values[i] for i in places], dtype=np.float64)
                bits, factor = encode(rows / np.linalg.norm(rows, axis=1, keepdims=True))
                for i, b, a in zip(places.tolist(), bits, factor.tolist()):
                    codes[i], factors[i] = b.tobytes(), a
            yield pa.RecordBatch.from_arrays([*table.columns, pa.array(codes, pa.binary()), pa.array(factors, pa.float64())], names=[*table.schema.names, "code", "factor"])

    schema = ", ".join(f"`{c}` {t}" for c, t in vectors.dtypes) + ", code binary, factor double"
    return vectors.mapInArrow(of, schema)


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct rows (vec_id, label, embedding as doubles, dim) that can link with anything."""
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.array_max(F.transform("embedding", F.abs))
    plain = plain.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(finite).where(largest > 0)
    # Divided by a power of two, so that no square is too large or too small and no other bit changes.
    unit = F.pow(F.lit(2.0), F.floor(F.log2(largest)))
    plain = plain.withColumn("unit", unit).withColumn("embedding", F.transform("embedding", lambda x: x / F.col("unit"))).drop("unit")
    return plain.dropDuplicates().withColumn("dim", F.size("embedding"))


def vector_links(vectors: DataFrame, threshold: float = THRESHOLD, deviations: float | None = None) -> DataFrame:
    """Rows (vec_id, n, root): links a vector has within one pair of blocks, and the smallest id they connect it to.

    Vectors of a label are dealt over blocks by hash, as many as its count asks for, so a hot label makes more tasks and
    not larger ones. Every two blocks of a label meet once.
    """
    rows = stored(coded(usable(vectors)), "vector-codes")
    blocks = stored(rows.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "vector-blocks")
    placed = rows.join(small_side(blocks), ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = placed.select("label", "dim", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "vec_id", "embedding", "code", "factor")

    def compare(table: pa.Table) -> pa.Table:
        low = table["low"][0].as_py()
        side = table["block"].to_numpy() == low
        ids = table["vec_id"].to_numpy()
        d = table["dim"][0].as_py()
        values = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        lengths = np.linalg.norm(values, axis=1)
        codes = np.frombuffer(b"".join(table["code"].to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
        factors = table["factor"].to_numpy()
        first = np.flatnonzero(side)
        second = first if low == table["high"][0].as_py() else np.flatnonzero(~side)
        reach = threshold - margins(factors[second], d, threshold, deviations)[None, :]
        lefts, rights = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for at in range(0, len(first), STEP):
            part = first[at : at + STEP]
            rows_at, cols_at = np.nonzero(estimates(values[part] / lengths[part, None], codes[second], factors[second]) >= reach)
            a, b = part[rows_at], second[cols_at]
            if second is first:
                a, b = a[a < b], b[a < b]
            a, b = a[ids[a] != ids[b]], b[ids[a] != ids[b]]
            for start in range(0, len(a), CHUNK):
                x, y = a[start : start + CHUNK], b[start : start + CHUNK]
                near = np.einsum("ij,ij->i", values[x], values[y]) / (lengths[x] * lengths[y]) >= threshold
                lefts.append(x[near])
                rights.append(y[near])
        a, b = np.concatenate(lefts), np.concatenate(rights)
        left, right = ids[a], ids[b]
        nodes, roots = forest(left, right)
        counts = np.bincount(np.searchsorted(nodes, np.concatenate([left, right])), minlength=len(nodes))
        return pa.table({"vec_id": nodes.astype(np.int64), "n": counts.astype(np.int64), "root": roots.astype(np.int64)})

    return met.groupBy("label", "dim", "low", "high").applyInArrow(compare, "vec_id long, n long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, deviations: float | None = None) -> DataFrame:
    """One row per vec_id: n_links, component_id and whether it is kept (it is the smallest of its component).

    Cosines are compared between vectors of equal label and size only. Null labels, vectors that are null, zero or hold
    null or non-finite components, and null ids link with nothing; a null id has a null component and is kept. Rows equal
    in all three columns count once; different vectors under one id are one node and links between them don't count.
    Other columns are ignored; an empty table gives no rows. With `deviations` pairs are passed over that would need a
    larger error than so many standard deviations; by default no pair is lost.
    """
    found = stored(vector_links(vectors, threshold, deviations), "vector-links")
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    groups = connected_components(found.select(F.col("vec_id").alias("src"), F.col("root").alias("dst")), "vector-components")
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    joined = ids.join(counts, "vec_id", "left").join(groups.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
