"""A stored index of vectors by cells.

Cells are the neighbourhoods of centres fitted on a bounded sample, about as many as the square root of the vectors. Every
vector is written to the folder of its cell, with its distance to the centre; a small table holds each cell's centre, its
radius and its number of vectors. A search reads the folders of the cells its questions probe and no others, unless there
are too many questions to travel whole: then it reads all and searches the probed ones. For an exact answer the k-th distance found there is a bound: a cell whose centre is farther than that plus its radius can hold nothing
nearer, and only the remaining cells are read in a second pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import isqrt
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.operators import vectors as search
from logquarry.operators.vectors import _matrix, fit_cells, knn_candidates, ranked, vector_bytes
from logquarry.session import shared_dir

# The table of centres is held in memory by driver and tasks, so cells are bounded; beyond it cells hold more vectors.
MOST_CELLS = 16_384
# Vectors per cell that the centres are fitted on, on average.
SAMPLE_PER_CELL = 64
# Distances measured at once.
AT_ONCE = 4_000_000
# Relative slack of the bounds against rounding.
SLACK = 1e-9


@dataclass(frozen=True)
class CellIndex:
    """The stored rows, partitioned by `cell`, and the cells' centres, radii and sizes by cell number."""

    rows: DataFrame
    centres: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray


def _distances(vectors: np.ndarray, centres: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Distances to all centres for some vectors at a time, with the place of the first."""
    step, norms = max(1, AT_ONCE // max(1, len(centres))), (centres**2).sum(1)
    for at in range(0, len(vectors), step):
        part = vectors[at : at + step].astype(np.float64)
        squares = (part**2).sum(1)[:, None] + norms[None, :] - 2.0 * part @ centres.T
        yield at, np.sqrt(np.maximum(squares, 0.0))


def build_index(corpus: DataFrame, path: str, cells: int | None = None, ident: str = "id", vector: str = "embedding") -> None:
    """Write the index of a corpus below `path`: all its columns, every row that has a vector.

    Centres are fitted on a sample of about SAMPLE_PER_CELL vectors per cell, chosen by a hash of the id; without `cells`
    there are as many as the square root of the vectors, at most MOST_CELLS. Vectors that differ in length or hold numbers
    that are null or not finite are an error; repeated rows are all kept; an empty corpus makes an index without cells.
    """
    known = corpus.where(F.col(vector).isNotNull())
    n = known.count()
    cells = min(cells or isqrt(n) or 1, MOST_CELLS, max(n, 1))
    centres = np.zeros((0, 0))
    if n:
        share = min(1.0, cells * SAMPLE_PER_CELL / n)
        sample = known.where(F.pmod(F.xxhash64(ident), F.lit(1 << 30)) < F.lit(share * (1 << 30)))
        centres = fit_cells(known if sample.isEmpty() else sample, cells, vector, iterations=5)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch[vector], "Corpus")
            cell, gap = np.zeros(len(vectors), dtype=np.int32), np.zeros(len(vectors))
            for at, found in _distances(vectors, centres):
                nearest = found.argmin(axis=1)
                cell[at : at + len(found)] = nearest
                # Measured once more, as the product form errs in the last digits.
                gap[at : at + len(found)] = np.sqrt(((vectors[at : at + len(found)] - centres[nearest]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(gap), pa.array(cell)], names=[*batch.schema.names, "gap", "cell"])

    schema = ", ".join(f"`{c}` {t}" for c, t in known.dtypes) + ", gap double, cell int"
    # Cells are gathered for few files each; a full cell is split among tasks.
    placed = known.mapInArrow(assign, schema)
    # An empty table has no folders; its columns are kept by an empty file.
    writer = placed.hint("rebalance", "cell").write.partitionBy("cell") if n else placed.write
    writer.mode("overwrite").parquet(f"{path}/rows")
    session = corpus.sparkSession
    stored = session.read.schema(schema).parquet(f"{path}/rows")
    facts = stored.groupBy("cell").agg(F.max("gap").alias("radius"), F.count(F.lit(1)).alias("n"))
    by_cell = session.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
    by_cell.join(facts, "cell", "left").write.mode("overwrite").parquet(f"{path}/cells")


def open_index(spark: SparkSession, path: str) -> CellIndex:
    """A stored index; what reaches the driver is the table of at most MOST_CELLS cells."""
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    centres = np.array([c["centre"] for c in cells], dtype=np.float64).reshape(len(cells), -1 if cells else 0)
    radii = np.array([-np.inf if c["radius"] is None else c["radius"] for c in cells])
    return CellIndex(spark.read.parquet(f"{path}/rows"), centres, radii, np.array([c["n"] or 0 for c in cells], dtype=np.int64))


def probed_cells(index: CellIndex, questions: DataFrame, probes: int) -> DataFrame:
    """The questions once per cell of their `probes` nearest centres that hold vectors."""
    centres, held = index.centres, np.flatnonzero(index.sizes > 0)
    if not len(held):
        return questions.limit(0).withColumn("cell", F.lit(0))

    @F.pandas_udf("array<int>")
    def nearest(vectors: pd.Series) -> pd.Series:
        found = []
        for _, distance in _distances(np.array([*vectors], dtype=np.float64).reshape(len(vectors), -1), centres[held]) if len(vectors) else ():
            found.extend(held[np.argsort(distance, axis=1, kind="stable")[:, :probes]].tolist())
        return pd.Series(found, dtype=object)

    return questions.withColumn("cell", F.explode(nearest("q")))


def _cells_within(index: CellIndex, bounded: DataFrame, probes: int) -> DataFrame:
    """Rows (question_id, q, cell): cells not probed yet that may hold a vector within the question's `bound` (squared;
    null: any)."""
    centres, radii, held = index.centres, index.radii, np.flatnonzero(index.sizes > 0)
    if not len(held):
        return bounded.limit(0).withColumn("cell", F.lit(0)).drop("bound")

    @F.pandas_udf("array<int>")
    def open_cells(vectors: pd.Series, bound: pd.Series) -> pd.Series:
        found, limits = [], np.sqrt(bound.fillna(np.inf).to_numpy(dtype=np.float64))
        for at, distance in _distances(np.array([*vectors], dtype=np.float64).reshape(len(vectors), -1), centres[held]) if len(vectors) else ():
            inside = _inside(distance, radii[held], limits[at : at + len(distance)], probes)
            found.extend(held[row].tolist() for row in inside)
        return pd.Series(found, dtype=object)

    return bounded.withColumn("cell", F.explode(open_cells("q", "bound"))).drop("bound")


def _first(distance: np.ndarray, probes: int) -> np.ndarray:
    """Which cells are a question's `probes` nearest, by rows of distances to the centres."""
    inside = np.zeros(distance.shape, dtype=bool)
    np.put_along_axis(inside, np.argsort(distance, axis=1, kind="stable")[:, :probes], True, axis=1)
    return inside


def _inside(distance: np.ndarray, radii: np.ndarray, limits: np.ndarray, probes: int) -> np.ndarray:
    """Which further cells may hold a vector within the limit."""
    slack = 1e-6 + SLACK * distance
    return (distance - radii[None, :] - slack <= limits[:, None]) & ~_first(distance, probes)


def cell_groups(index: CellIndex, dim: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Per cell its first group and its number of groups, and the number of all: cells one after another up to
    GROUP_BYTES of vectors together, larger ones over several groups."""
    size = index.sizes * dim * 4
    pieces = np.maximum(1, -(-size // search.GROUP_BYTES))
    first, at, filled = np.zeros(len(size), dtype=np.int32), 0, 0
    for cell in range(len(size)):
        if filled and filled + size[cell] > search.GROUP_BYTES:
            at, filled = at + 1, 0
        first[cell] = at
        filled += size[cell]
        if pieces[cell] > 1:
            at, filled = at + int(pieces[cell]), 0
    return first, pieces.astype(np.int32), int((first + pieces).max(initial=1))


def _meet_cells(index: CellIndex, asked: DataFrame, size: int, k: int, opened: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(question_id, id, score, n): the k nearest vectors of each question in the cells that are open to it.

    For question sets that do not travel whole. `asked` holds (question_id, q, bound), `opened` tells from distances to the
    centres of the cells that hold vectors, and bounds, which are open. A question is sent once to a group of cells, with
    the numbers of those open to it, however many these are.
    """
    session, centres, held = asked.sparkSession, index.centres, np.flatnonzero(index.sizes > 0)
    first, pieces, corpus_groups = cell_groups(index, centres.shape[1])
    _, question_groups = search.group_numbers(session, corpus_groups * search.GROUP_BYTES, size)
    last = first + pieces - 1
    inside = [np.flatnonzero((first[held] <= g) & (g <= last[held])) for g in range(corpus_groups)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch["q"], "Question")
            if vectors.shape[1] != centres.shape[1]:
                raise ValueError(f"Question vectors have {vectors.shape[1]} numbers, corpus vectors {centres.shape[1]}")
            bounds = batch["bound"].fill_null(np.inf).to_numpy(zero_copy_only=False)
            for at, distance in _distances(vectors, centres[held]):
                is_open = opened(distance, bounds[at : at + len(distance)])
                part = batch.slice(at, len(distance)).select(["question_id", "q", "n", "question_group"])
                for group, cells in enumerate(inside):
                    rows = np.flatnonzero(is_open[:, cells].any(axis=1))
                    if not len(rows):
                        continue
                    of, place = np.nonzero(is_open[np.ix_(rows, cells)])
                    offsets = np.searchsorted(of, np.arange(len(rows) + 1)).astype(np.int32)
                    keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(held[cells][place], pa.int32()))
                    sent = part.take(pa.array(rows))
                    sent = pa.RecordBatch.from_arrays([*sent.columns, keys], names=[*sent.schema.names, "key"])
                    for blob in search.packed_groups(sent, "question_group"):
                        yield pa.RecordBatch.from_arrays([*blob.columns, pa.array([group], pa.int32())], names=["question_group", "rows", "corpus_group"])

    number = F.col("question_id").cast("bigint").alias("question_id")
    numbers = F.col("q").cast("array<float>").alias("q")
    dealt = F.pmod(F.xxhash64(number, numbers), F.lit(question_groups)).cast("int").alias("question_group")
    questions = asked.select(number, numbers, F.lit(k).alias("n"), F.col("bound").cast("double"), dealt)
    questions = questions.mapInArrow(deal, "question_group int, rows binary, corpus_group int")
    # As many rows as there are cells.
    placed = session.createDataFrame([(c, int(first[c]), int(pieces[c])) for c in held.tolist()], "cell int, first int, pieces int")
    rows = index.rows.select(F.col("cell").alias("key"), F.col("id").cast("bigint").alias("ident"), F.col("embedding").cast("array<float>").alias("vector"))
    rows = rows.join(F.broadcast(placed.withColumnRenamed("cell", "key")), "key")
    piece = F.col("first") + F.pmod(F.xxhash64("ident", "vector"), "pieces").cast("int")
    stored = search.packed(rows.select("key", "ident", "vector", piece.alias("corpus_group")), "corpus_group")
    stored = stored.withColumn("question_group", F.explode(F.sequence(F.lit(0), F.lit(question_groups - 1))))
    return search.meet(questions, stored, corpus_groups * question_groups, "int", merged=True)


def knn_probed(
    index: CellIndex, questions: DataFrame, probes: int, k: int = 5, broadcast_bytes: int = search.BROADCAST_BYTES, **options
) -> DataFrame:
    """(question_id, rank, id, score): the k nearest vectors within the `probes` nearest cells of each question.

    Scores are exact squared distances, so every hit is a true distance; nearer vectors in other cells may be missed.
    Questions without a vector get no hits.
    """
    asked = questions.where(F.col("q").isNotNull())
    size = asked.agg(vector_bytes("q")).first()[0] or 0
    if size * min(probes, len(index.centres)) > broadcast_bytes:
        open_to_all = asked.withColumn("bound", F.lit(None).cast("double"))
        found = _meet_cells(index, open_to_all, size, k, lambda distance, bounds: _first(distance, probes))
    else:
        found = knn_candidates(index.rows, probed_cells(index, asked, probes).withColumn("n", F.lit(k)), "cell", broadcast_bytes=broadcast_bytes, **options)
    return ranked(found, ["question_id"], k).select("question_id", "rank", "id", "score")


def knn_indexed(
    index: CellIndex, questions: DataFrame, k: int = 5, probes: int = 2, broadcast_bytes: int = search.BROADCAST_BYTES, **options
) -> DataFrame:
    """(question_id, rank, id, score): the k nearest vectors, exact, searching only cells that can hold one of them; small
    question sets read no others, large ones read the whole index."""
    asked = questions.where(F.col("q").isNotNull()).select("question_id", "q")
    path = shared_dir(asked.sparkSession, f"probed-{uuid4().hex}")
    knn_probed(index, asked, probes, k, broadcast_bytes, **options).write.parquet(path)
    first = asked.sparkSession.read.parquet(path)
    bounds = first.where(F.col("rank") == k).select("question_id", F.col("score").alias("bound"))
    bounded = asked.join(bounds, "question_id", "left")
    size = bounded.agg(vector_bytes("q")).first()[0] or 0
    if size * len(index.centres) > broadcast_bytes:
        radii = index.radii[index.sizes > 0]
        rest = _meet_cells(index, bounded, size, k, lambda distance, squares: _inside(distance, radii, np.sqrt(squares), probes))
    else:
        more = _cells_within(index, bounded, probes).withColumn("n", F.lit(k))
        rest = knn_candidates(index.rows, more, "cell", broadcast_bytes=broadcast_bytes, **options)
    rest = rest.select("question_id", "id", "score")
    return ranked(first.select("question_id", "id", "score").unionByName(rest), ["question_id"], k).select("question_id", "rank", "id", "score")


def read_share(index: CellIndex, questions: DataFrame, probes: int) -> DataFrame:
    """One row: read_share, the share of all (question, vector) pairs that the probed cells hold."""
    probed = probed_cells(index, questions.where(F.col("q").isNotNull()).select("question_id", "q"), probes)
    sizes = F.element_at(F.array(*[F.lit(int(x)) for x in index.sizes]), F.col("cell") + 1)
    total = int(index.sizes.sum()) * questions.where(F.col("q").isNotNull()).count()
    return probed.agg((F.sum(sizes) / F.lit(total)).alias("read_share"))
