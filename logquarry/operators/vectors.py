"""Embedding hook and vector top-k, exact and approximate.

Exact search is a blocked product. Few questions, by their measured size, travel to all tasks; each task multiplies its part
of the corpus, as it streams by, with the question blocks of the rows' keys (domain or cell) and keeps only the k best rows
per question. Of many questions nothing passes through the driver: both sides are packed, dealt over groups of bounded size,
and every two groups meet in one task. The number of (question, vector) pairs never becomes a number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from logquarry.fixed_values import SEED, VECTOR_DIM

ANY = "*"
# Questions measured at once.
QUESTION_BLOCK = 256
# Bytes of question vectors that travel to every task; larger question sets meet the corpus in groups.
BROADCAST_BYTES = 32 * 1024 * 1024
# Bytes of vectors in a group of either side.
GROUP_BYTES = 32 * 1024 * 1024
# Tasks per core at least, so that none waits long for the last ones.
TASKS_PER_CORE = 2
# Corpus vectors measured at once.
CORPUS_BLOCK = 2048
# Up to this many asked keys the corpus is filtered to them, which prunes a corpus partitioned by its key.
MAX_PRUNED_KEYS = 100_000
# Numbers of pairs measured exactly in one step.
NUMBERS_AT_ONCE = 4_194_304
# Vectors with at most one number in so many that is not zero are packed without their zeros.
SPARSE = 4
PLACES = "@places"
# Vectors looked at to tell how much room a set of them takes when packed.
SIZE_SAMPLE = 256
# Squared lengths beyond this are screened in double precision.
SINGLE_LIMIT = 1e30
# Up to this many asked domains the corpus is filtered to them before it is packed.
MAX_PRUNED_DOMAINS = 1000
MOST_PARTITIONS = 20_000


def embed_texts(
    df: DataFrame, text: str = "text", embed: Callable[[list[str]], list] | None = None, dim: int = VECTOR_DIM,
    out: str = "embedding", batch: int = 256,
) -> DataFrame:
    """Add a float vector per text.

    `embed` maps a list of texts to a list of vectors of length `dim` and is called in batches on the
    executors. Without it texts are hashed term counts of unit length, made by Spark's own transformers.
    """
    if embed is None:
        counted = HashingTF(inputCol="_terms", outputCol="_counts", numFeatures=dim).transform(
            Tokenizer(inputCol="_text", outputCol="_terms").transform(
                df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
            )
        )
        unit = Normalizer(inputCol="_counts", outputCol="_unit").transform(counted)
        return unit.withColumn(out, vector_to_array("_unit", "float32")).drop("_text", "_terms", "_counts", "_unit")

    schema = StructType([*df.schema.fields, StructField(out, ArrayType(FloatType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch].copy()
                vectors = [np.asarray(v, dtype=np.float32) for v in embed(part[text].tolist())]
                if len(vectors) != len(part) or any(v.shape != (dim,) for v in vectors):
                    raise ValueError(f"embed must return one vector of length {dim} per text")
                part[out] = vectors
                yield part

    return df.mapInPandas(run, schema)


class SparseRows:
    """Vectors kept as their numbers other than zero; rows asked for come back whole."""

    def __init__(self, starts: np.ndarray, places: np.ndarray, values: np.ndarray, width: int):
        self.starts, self.places, self.values, self.shape = starts, places, values, (len(starts) - 1, width)

    @classmethod
    def of(cls, vectors: np.ndarray) -> SparseRows:
        rows, places = np.nonzero(vectors)
        return cls(np.searchsorted(rows, np.arange(len(vectors) + 1)), places.astype(np.int32), vectors[rows, places], vectors.shape[1])

    @classmethod
    def joined(cls, parts: list[SparseRows]) -> SparseRows:
        offsets = np.cumsum([0, *[len(p.values) for p in parts]])
        starts = np.concatenate([[0], *[p.starts[1:] - p.starts[0] + at for p, at in zip(parts, offsets)]])
        places, values = (np.concatenate([getattr(p, c) for p in parts]) for c in ("places", "values"))
        return cls(starts, places, values, parts[0].shape[1])

    def __len__(self) -> int:
        return self.shape[0]

    def _numbers(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many numbers the rows have up to each of them, and where these are."""
        lengths = self.starts[rows + 1] - self.starts[rows]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ends, np.arange(ends[-1]) + np.repeat(self.starts[rows] - ends[:-1], lengths)

    def take(self, rows: np.ndarray) -> SparseRows:
        ends, at = self._numbers(rows)
        return SparseRows(ends, self.places[at], self.values[at], self.shape[1])

    def __getitem__(self, rows) -> np.ndarray:
        rows = np.arange(len(self))[rows]
        ends, at = self._numbers(rows)
        whole = np.zeros((len(rows), self.shape[1]), dtype=np.float32)
        whole[np.repeat(np.arange(len(rows)), np.diff(ends)), self.places[at]] = self.values[at]
        return whole


def _taken(vectors: np.ndarray | SparseRows, rows: np.ndarray) -> np.ndarray | SparseRows:
    return vectors.take(rows) if isinstance(vectors, SparseRows) else vectors[rows]


def _squares(vectors: np.ndarray | SparseRows) -> np.ndarray:
    """Squared lengths."""
    blocks = (vectors[at : at + CORPUS_BLOCK] for at in range(0, len(vectors), CORPUS_BLOCK))
    return np.concatenate([np.zeros(0), *[(block.astype(np.float64) ** 2).sum(1) for block in blocks]])


def _row_hashes(vectors: np.ndarray | SparseRows) -> np.ndarray:
    """64 bits per vector, equal for equal ones."""
    factors = np.random.default_rng(7).integers(0, 2**64, vectors.shape[1], dtype=np.uint64) | np.uint64(1)
    if isinstance(vectors, SparseRows):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(vectors.values.view(np.uint32) * factors[vectors.places], dtype=np.uint64)])
        return sums[vectors.starts[1:]] - sums[vectors.starts[:-1]]
    found = np.zeros(len(vectors), dtype=np.uint64)
    for at in range(0, len(vectors), CORPUS_BLOCK):
        bits = np.ascontiguousarray(vectors[at : at + CORPUS_BLOCK]).view(np.uint32)
        found[at : at + CORPUS_BLOCK] = (bits * factors).sum(axis=1, dtype=np.uint64)
    return found


def _without_spare_copies(ids: np.ndarray, vectors: np.ndarray | SparseRows, n: int) -> np.ndarray:
    """Positions to keep: of equal vectors the n lowest ids. A further copy has n others in front of it for
    every question, so no top-n holds it; without this step a much copied vector would tie with itself.

    Vectors are told apart by hashes; where more than n share one, they are compared in full, and all are kept if any differ."""
    hashes = _row_hashes(vectors)
    order = np.lexsort((ids, hashes))
    starts = np.searchsorted(hashes[order], hashes[order])
    place = np.arange(len(order)) - starts
    spare = place >= n
    if not spare.any():
        return np.arange(len(order))
    many = np.flatnonzero(np.isin(starts, starts[spare]))
    differ = np.zeros(len(order), dtype=bool)
    for at in range(0, len(many), CORPUS_BLOCK):
        part = many[at : at + CORPUS_BLOCK]
        differ[starts[part[(vectors[order[part]] != vectors[order[starts[part]]]).any(axis=1)]]] = True
    return np.sort(order[~spare | differ[starts]])


class _Nearest:
    """The n nearest vectors so far of each question: squared distances and ids, sorted, ties by id."""

    def __init__(self, question_ids: np.ndarray, questions: np.ndarray | SparseRows, n: int):
        self.question_ids, self.questions, self.n = question_ids, questions, n
        self.norms = _squares(questions)
        self.distance = np.full((len(questions), n), np.inf)
        self.ids = np.full((len(questions), n), np.iinfo(np.int64).max)

    def search(self, ids: np.ndarray, vectors: np.ndarray | SparseRows, rows: np.ndarray | None = None) -> None:
        """Take in corpus vectors, for the questions in the given rows only or for all."""
        rows = np.arange(len(self.questions)) if rows is None else rows
        if not len(rows):
            return
        for start in range(0, len(ids), CORPUS_BLOCK):
            part = vectors[start : start + CORPUS_BLOCK]
            norms = (part.astype(np.float64) ** 2).sum(1)
            single = max(norms.max(), self.norms[rows].max()) < SINGLE_LIMIT
            screen = np.column_stack([part, norms]).astype(np.float32 if single else np.float64)
            for at in range(0, len(rows), QUESTION_BLOCK):
                self._see(rows[at : at + QUESTION_BLOCK], ids[start : start + CORPUS_BLOCK], part, screen, norms.max())

    def _see(self, asked: np.ndarray, ids: np.ndarray, vectors: np.ndarray, screen: np.ndarray, longest: float) -> None:
        norms, questions = self.norms[asked], self.questions[asked].astype(screen.dtype)
        lead = np.column_stack([-2 * questions, np.ones(len(asked), screen.dtype)])
        # Squared distances but for the question's own length.
        rough = lead @ screen.T
        # The product errs in the last digits, in single precision more: keep all it cannot tell from the limit, then
        # measure exactly.
        error = 1e-9 * (1.0 + norms + longest)
        error += (screen.shape[1] + 4) * float(np.finfo(screen.dtype).eps) * (np.sqrt(norms) + np.sqrt(longest)) ** 2
        limit = self.distance[asked, -1] - norms + error
        if len(ids) > self.n and np.isinf(limit).any():
            limit = np.minimum(limit, np.partition(rough, self.n - 1, axis=1)[:, self.n - 1] + 2 * error)
        rows, columns = np.nonzero(rough <= np.nextafter(limit.astype(screen.dtype), screen.dtype.type(np.inf))[:, None])
        step = max(1, NUMBERS_AT_ONCE // max(1, vectors.shape[1]))
        for start in range(0, len(rows), step):
            part = slice(start, start + step)
            self._merge(asked[rows[part]], ids[columns[part]], self._exact(asked[rows[part]], vectors, columns[part]))

    def _exact(self, rows, vectors, columns):
        return ((vectors[columns].astype(np.float64) - self.questions[rows]) ** 2).sum(axis=1)

    def _merge(self, rows, ids, distance) -> None:
        touched, group = np.unique(rows, return_inverse=True)
        group = np.concatenate([group, np.repeat(np.arange(len(touched)), self.n)])
        distance = np.concatenate([distance, self.distance[touched].ravel()])
        ids = np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((ids, distance, group))
        first = np.searchsorted(group[order], np.arange(len(touched)))
        best = order[first[:, None] + np.arange(self.n)]
        self.distance[touched], self.ids[touched] = distance[best], ids[best]

    def found(self) -> list[np.ndarray]:
        rows, places = np.nonzero(np.isfinite(self.distance))
        return [self.question_ids[rows], self.ids[rows, places], self.distance[rows, places]]


def vector_bytes(vector: str) -> Column:
    return F.sum(F.size(vector).cast("bigint") * 4)


def _matrix(column: pa.Array | pa.ChunkedArray, what: str) -> np.ndarray:
    """Vectors of one length with finite numbers as rows of single precision."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.unique(np.diff(np.asarray(flat.offsets)))
    if len(lengths) > 1:
        raise ValueError(f"{what} vectors differ in length")
    numbers = flat.flatten()
    found = np.asarray(numbers.to_numpy(zero_copy_only=False), dtype=np.float32).reshape(len(flat), -1)
    if numbers.null_count or not np.isfinite(found).all():
        raise ValueError(f"{what} vectors hold numbers that are null or not finite")
    return found


def _question_blocks(asked: DataFrame, key: str | None, question_vector: str) -> dict:
    """Per key, blocks (ids, vectors, n) of questions whose size has been measured."""
    names = [*([key] if key else []), "question_id", question_vector, "n"]
    rows = asked.select(*[F.col(f"`{c}`") for c in names]).toArrow()
    vectors = _matrix(rows[question_vector], "Question") if rows.num_rows else np.zeros((0, 1), dtype=np.float32)
    ids, limits = rows["question_id"].to_numpy(), rows["n"].to_numpy()
    keys = rows[key].to_pylist() if key else [None] * rows.num_rows
    places: dict = {}
    for place, of in enumerate(zip(keys, limits.tolist())):
        places.setdefault(of, []).append(place)
    blocks: dict = {}
    for (value, n), found in places.items():
        blocks.setdefault(value, []).append((ids[found], vectors[found], n))
    return blocks


def _places(column: pa.Array | None, n: int) -> Iterator[tuple[object, np.ndarray]]:
    """Each key of a column of keys or arrays of keys with the places of its rows; without keys all rows under None."""
    if column is None:
        yield None, np.arange(n)
        return
    owner = np.arange(n)
    if pa.types.is_list(column.type):
        owner, column = np.asarray(pc.list_parent_indices(column)), pc.list_flatten(column)
    coded = pc.dictionary_encode(column)
    codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    cuts = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
    for value, a, b in zip(coded.dictionary.to_pylist(), cuts, cuts[1:]):
        yield value, np.unique(owner[order[a:b]])


def _hits(nearest: _Nearest, value: object, key_arrow: pa.DataType | None) -> list[pa.Array]:
    question_ids, found, distance = nearest.found()
    keys = [] if key_arrow is None else [pa.array([value], key_arrow).take(pa.array(np.zeros(len(found), np.int32)))]
    return [*keys, pa.array(question_ids, pa.int64()), pa.array(found, pa.int64()), pa.array(distance), pa.array(np.full(len(found), nearest.n), pa.int32())]


def _hit_columns(key_type: str, keyed: bool) -> tuple[pa.DataType, str, list[str]]:
    """Arrow type of the key, Spark schema and names of what a search finds."""
    schema = f"key {key_type}, " * keyed + "question_id bigint, id bigint, score double, n int"
    return {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}[key_type], schema, ["key"] * keyed + ["question_id", "id", "score", "n"]


def _scan(corpus: DataFrame, blocks: dict, key: str | None, ident: str, vector: str, key_type: str) -> DataFrame:
    """One pass over the corpus: each task's nearest vectors per question."""
    rows = corpus.where(F.col(vector).isNotNull())
    if key is not None and not dict(corpus.dtypes)[key].startswith("array") and len(blocks) <= MAX_PRUNED_KEYS:
        rows = rows.where(F.col(key).isin([k for k in blocks if k is not None]))
    columns = [F.col(ident).cast("bigint").alias("ident"), F.col(vector).cast("array<float>").alias("vector")]
    rows = rows.select(*([F.col(key).alias("key")] if key else []), *columns)
    most = max((n for of in blocks.values() for _, _, n in of), default=0)
    dim = next((vectors.shape[1] for of in blocks.values() for _, vectors, _ in of), None)
    shared = corpus.sparkSession.sparkContext.broadcast(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for batch in batches:
            if not batch.num_rows or dim is None:
                continue
            vectors, ids = _matrix(batch["vector"], "Corpus"), np.asarray(batch["ident"])
            if vectors.shape[1] != dim:
                raise ValueError(f"Question vectors have {dim} numbers, corpus vectors {vectors.shape[1]}")
            for value, places in _places(batch["key"] if key is not None else None, batch.num_rows):
                if value not in shared.value:
                    continue
                places = places[_without_spare_copies(ids[places], vectors[places], most)]
                if value not in kept:
                    kept[value] = [_Nearest(q_ids, q, n) for q_ids, q, n in shared.value[value]]
                for nearest in kept[value]:
                    nearest.search(ids[places], vectors[places])
        for value, of in kept.items():
            for nearest in of:
                yield pa.RecordBatch.from_arrays(_hits(nearest, value, key_arrow if key is not None else None), names=names)

    key_arrow, schema, names = _hit_columns(key_type, key is not None)
    found = rows.mapInArrow(run, schema)
    return found if key is None else found.withColumnRenamed("key", key)


def packed(rows: DataFrame, group: str) -> DataFrame:
    """(group, rows): the rows of one group in a batch as one Arrow table, so that Spark moves bytes and no numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from packed_groups(batch, group)

    return rows.mapInArrow(run, f"`{group}` int, rows binary")


def _compact(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch, its vectors that are mostly zeros without these: other numbers in the column, their places in one beside it,
    the vectors' length in the schema's notes."""
    columns, widths = {}, {}
    for name, column in zip(batch.schema.names, batch.columns):
        columns[name] = column
        if not pa.types.is_list(column.type) or not pa.types.is_floating(column.type.value_type) or column.null_count:
            continue
        lengths, numbers = np.diff(np.asarray(column.offsets)), column.flatten()
        if numbers.null_count or not len(numbers) or lengths.min() != lengths.max():
            continue
        flat, width = numbers.to_numpy(zero_copy_only=False), int(lengths[0])
        kept = np.flatnonzero(flat)
        if len(kept) * SPARSE > len(flat):
            continue
        offsets = pa.array(np.searchsorted(kept, np.arange(len(lengths) + 1) * width).astype(np.int32))
        columns[name] = pa.ListArray.from_arrays(offsets, pa.array(flat[kept], pa.float32()))
        columns[name + PLACES] = pa.ListArray.from_arrays(offsets, pa.array((kept % width).astype(np.int32)))
        widths[name] = str(width)
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns)).replace_schema_metadata(widths)


def packed_groups(batch: pa.RecordBatch, group: str) -> Iterator[pa.RecordBatch]:
    codes = batch[group].to_numpy()
    order = np.argsort(codes, kind="stable")
    sorted_rows = _compact(batch.select([c for c in batch.schema.names if c != group])).take(pa.array(order))
    cuts = [0, *(np.flatnonzero(np.diff(codes[order])) + 1).tolist(), len(order)]
    for a, b in zip(cuts, cuts[1:]):
        blob = pa.array([table_bytes(sorted_rows.slice(a, b - a))], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([codes[order[a]]], pa.int32()), blob], names=[group, "rows"])


def unpacked(blobs: pa.ChunkedArray, vector: str, what: str) -> tuple[pa.Table, np.ndarray | SparseRows] | tuple[None, None]:
    """Packed rows without their vectors, and the vectors: as a matrix, or as sparse rows if any were packed as such."""
    if not len(blobs):
        return None, None
    rows, found = [], []
    for blob in blobs:
        part = pa.ipc.open_stream(blob.as_buffer()).read_all()
        rows.append(part.select([c for c in part.column_names if c not in (vector, vector + PLACES)]).replace_schema_metadata(None))
        width = (part.schema.metadata or {}).get(vector.encode())
        if width is None:
            found.append(_matrix(part[vector], what))
            continue
        values, places = (part[c].combine_chunks() for c in (vector, vector + PLACES))
        numbers = np.asarray(values.flatten())
        if not np.isfinite(numbers).all():
            raise ValueError(f"{what} vectors hold numbers that are null or not finite")
        starts = np.asarray(values.offsets).astype(np.int64)
        found.append(SparseRows(starts - starts[0], np.asarray(places.flatten()), numbers, int(width)))
    if len({vectors.shape[1] for vectors in found}) > 1:
        raise ValueError(f"{what} vectors differ in length")
    if any(isinstance(vectors, SparseRows) for vectors in found):
        vectors = SparseRows.joined([v if isinstance(v, SparseRows) else SparseRows.of(v) for v in found])
    else:
        vectors = np.concatenate(found) if len(found) > 1 else found[0]
    return pa.concat_tables(rows).combine_chunks(), vectors


def packed_share(rows: DataFrame, vector: str) -> tuple[float, float]:
    """Bytes that a vector takes when packed, and their share of what it takes with its zeros, by a few of the vectors: sizes of
    groups follow from them, no result does."""
    sample = rows.select(vector).where(F.col(vector).isNotNull()).limit(SIZE_SAMPLE).toArrow()[vector].combine_chunks()
    numbers = np.asarray(sample.flatten().fill_null(1.0))
    if not len(numbers):
        return 0.0, 1.0
    kept = np.count_nonzero(numbers)
    share = 2 * kept / len(numbers) if kept * SPARSE <= len(numbers) else 1.0
    return share * 4 * len(numbers) / len(sample), share


def table_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def group_numbers(session: SparkSession, corpus_bytes: int, question_bytes: int) -> tuple[int, int]:
    """Groups of corpus and questions: of bounded size, and with enough pairs to keep all cores busy."""
    corpus, questions = (max(1, -(-size // GROUP_BYTES)) for size in (corpus_bytes, question_bytes))
    return corpus, max(questions, -(-TASKS_PER_CORE * session.sparkContext.defaultParallelism // corpus))


def balanced_groups(session: SparkSession, corpus_bytes: int, question_bytes: int) -> tuple[int, int]:
    """`group_numbers` by which least is shuffled: every group of a side is sent once per group of the other."""
    fewest, most = group_numbers(session, corpus_bytes, question_bytes)[0], TASKS_PER_CORE * session.sparkContext.defaultParallelism
    of_questions = max(1, -(-question_bytes // GROUP_BYTES))
    choices = [(n, max(of_questions, -(-most // n))) for n in range(fewest, max(fewest, most) + 1)]
    return min(choices, key=lambda groups: question_bytes * groups[0] + corpus_bytes * groups[1])


def meet(questions: DataFrame, corpus: DataFrame, pairs: int, key_type: str | None = None, merged: bool = False) -> DataFrame:
    """Nearest vectors per question of every pair of groups; both sides hold (question_group, corpus_group, rows).

    Packed questions are (question_id, q, n) and with `key_type` a key or an array of keys, packed vectors (ident, vector)
    and the same. Result: (key, question_id, id, score, n). `merged` questions have one `n` in a group and get their n
    nearest under all of their keys together, without a key.
    """

    def members(side: pa.Table) -> Iterator[tuple[object, np.ndarray]]:
        return _places(side["key"].combine_chunks() if key_type else None, side.num_rows)

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        (asked, queries), (stored, vectors) = unpacked(left["rows"], "q", "Question"), unpacked(right["rows"], "vector", "Corpus")
        found = []
        if queries is not None and vectors is not None:
            if queries.shape[1] != vectors.shape[1]:
                raise ValueError(f"Question vectors have {queries.shape[1]} numbers, corpus vectors {vectors.shape[1]}")
            question_ids, limits, ids = asked["question_id"].to_numpy(), asked["n"].to_numpy(), stored["ident"].to_numpy()
            wanted = dict(members(asked))
            every = _Nearest(question_ids, queries, int(limits[0])) if merged else None
            for value, places in members(stored):
                if value not in wanted:
                    continue
                own = _taken(vectors, places)
                kept = _without_spare_copies(ids[places], own, int(limits[wanted[value]].max()))
                if len(kept) < len(places):
                    places, own = places[kept], _taken(own, kept)
                if merged:
                    every.search(ids[places], own, wanted[value])
                    continue
                for n in np.unique(limits[wanted[value]]).tolist():
                    rows = wanted[value][limits[wanted[value]] == n]
                    one = _Nearest(question_ids[rows], _taken(queries, rows), n)
                    one.search(ids[places], own)
                    found.append(_hits(one, value, key_arrow if keyed else None))
            if merged:
                found.append(_hits(every, None, None))
        return pa.concat_tables([pa.Table.from_arrays(part, names=names) for part in found] or [empty])

    keyed = key_type is not None and not merged
    key_arrow, schema, names = _hit_columns(key_type or "string", keyed)
    empty = pa.table({c: pa.array([], t) for c, t in zip(names, [key_arrow] * keyed + [pa.int64(), pa.int64(), pa.float64(), pa.int32()])})
    # A number of partitions of its own: each pair of groups is long work on few bytes.
    groups = ["question_group", "corpus_group"]
    sides = [side.repartition(max(1, min(2 * pairs, MOST_PARTITIONS)), *groups).groupBy(*groups) for side in (questions, corpus)]
    return sides[0].cogroup(sides[1]).applyInArrow(nearest, schema)


def _meet_all(corpus: DataFrame, asked: DataFrame, key: str | None, ident: str, vector: str, question_vector: str, question_bytes: int) -> DataFrame:
    """Every question group with every group of the corpus."""
    session, key_type = corpus.sparkSession, dict(asked.dtypes)[key] if key else None
    counted = corpus
    if key is not None and not dict(corpus.dtypes)[key].startswith("array"):
        keys = [r[0] for r in asked.select(key).distinct().limit(MAX_PRUNED_KEYS + 1).collect()]
        if len(keys) <= MAX_PRUNED_KEYS:
            counted = corpus.where(F.col(key).isin([k for k in keys if k is not None]))
    rows = counted.where(F.col(vector).isNotNull())
    # Counted with rows that have no vector, so that no vector is read for it.
    each, _ = packed_share(corpus, vector)
    _, share = packed_share(asked, question_vector)
    corpus_groups, question_groups = balanced_groups(session, round(counted.count() * each), round(question_bytes * share))
    keys = [F.col(f"`{key}`").alias("key")] if key else []

    def dealt(ident: Column, vector: Column, groups: int) -> Column:
        return F.pmod(F.xxhash64(ident, vector), F.lit(groups)).cast("int")

    number, numbers = F.col(ident).cast("bigint").alias("ident"), F.col(vector).cast("array<float>").alias("vector")
    stored = packed(rows.select(*keys, number, numbers, dealt(number, numbers, corpus_groups).alias("corpus_group")), "corpus_group")
    stored = stored.withColumn("question_group", F.explode(F.sequence(F.lit(0), F.lit(question_groups - 1))))
    number, numbers = F.col("question_id"), F.col(question_vector).cast("array<float>").alias("q")
    questions = packed(asked.select(*keys, number, numbers, "n", dealt(number, numbers, question_groups).alias("question_group")), "question_group")
    questions = questions.withColumn("corpus_group", F.explode(F.sequence(F.lit(0), F.lit(corpus_groups - 1))))
    found = meet(questions, stored, corpus_groups * question_groups, key_type)
    return found if key is None else found.withColumnRenamed("key", key)


def knn_candidates(
    corpus: DataFrame, questions: DataFrame, key: str | None = None, ident: str = "id", vector: str = "embedding",
    question_vector: str = "q", broadcast_bytes: int = BROADCAST_BYTES, question_bytes: int | None = None,
) -> DataFrame:
    """(key, question_id, id, score, n): for each question row, at least its `n` nearest vectors with an equal key.

    `questions` holds (key, question_id, q, n); without `key` every question meets every vector. The corpus's key may be
    an array: the row then has each of its names. Each task gives its n best per question, so the result is a superset
    that the caller ranks. The questions' size is measured first; up to `broadcast_bytes` they travel to all tasks, and
    the corpus is neither shuffled nor joined. Beyond, groups of both sides meet, so what is shuffled is each side times the
    other's number of groups. Null vectors are not searched; vectors of another length, or with numbers that are null or not
    finite, are an error.
    """
    asked = questions.where(F.col(question_vector).isNotNull())
    asked = asked.withColumns({"n": F.col("n").cast("int"), "question_id": F.col("question_id").cast("bigint")})
    if question_bytes is None:
        question_bytes = asked.agg(vector_bytes(question_vector)).first()[0]
    if (question_bytes or 0) > broadcast_bytes:
        return _meet_all(corpus, asked, key, ident, vector, question_vector, question_bytes)
    key_type = dict(asked.dtypes)[key] if key else "string"
    return _scan(corpus, _question_blocks(asked, key, question_vector), key, ident, vector, key_type)


def ranked(candidates: DataFrame, group: list[str], k) -> DataFrame:
    window = Window.partitionBy(*group).orderBy("score", "id")
    return candidates.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def knn_global(corpus: DataFrame, questions: DataFrame, k: int = 5, **options) -> DataFrame:
    """(question_id, rank, id, score): the k nearest corpus vectors of each question (question_id, q)."""
    candidates = knn_candidates(corpus, questions.withColumn("n", F.lit(k)), **options)
    return ranked(candidates, ["question_id"], k).select("question_id", "rank", "id", "score")


def knn_filtered(corpus: DataFrame, questions: DataFrame, domain: str, k: int = 5, **options) -> DataFrame:
    """`knn_global` inside one domain; a corpus partitioned by domain is read for that domain only."""
    return knn_global(corpus.where(F.col("domain") == domain), questions, k, **options)


@dataclass
class RouteFacts:
    """Sizes of a set of routes, measured once: bytes of vectors, hits asked for in all and at most, domains."""

    question_bytes: int
    hits: int
    most: int
    domains: list[str]

    @classmethod
    def measure(cls, routes: DataFrame) -> RouteFacts:
        sizes = routes.agg(vector_bytes("q"), F.sum(F.col("n").cast("bigint")), F.max("n")).first()
        domains = routes.select("domain").distinct().limit(MAX_PRUNED_DOMAINS + 1).collect()
        return cls(sizes[0] or 0, sizes[1] or 0, sizes[2] or 0, [row[0] for row in domains])


def knn_routed(
    corpus: DataFrame, routes: DataFrame, facts: RouteFacts | None = None, subdomains: Column | None = None, **options
) -> DataFrame:
    """Search each (question_id, q, domain, n) route for its n nearest vectors of that domain.

    Domain `*` stands for the whole corpus. `subdomains` is an array column of the corpus with further names, each the
    row's domain, `#` and a suffix, under which a route finds the row. Result: (question_id, domain, rank, id, score),
    ranked per route.
    """
    facts = facts or RouteFacts.measure(routes)
    most, asked = facts.most, facts.domains
    if ANY in asked or subdomains is not None:
        names = F.array(F.col("domain"), F.lit(ANY))
        if ANY not in asked and len(asked) <= MAX_PRUNED_DOMAINS:
            # On a corpus partitioned by domain this reads the asked folders only.
            corpus = corpus.where(F.col("domain").isin([d.split("#")[0] for d in asked if d is not None]))
        keyed = corpus.withColumn("_key", names if subdomains is None else F.concat(names, subdomains))
    else:
        keyed = corpus.withColumn("_key", F.col("domain"))
    candidates = knn_candidates(keyed, routes.withColumn("_key", F.col("domain")), "_key", question_bytes=facts.question_bytes, **options)
    # The constant bound lets Spark cut each task's rows before the shuffle; n is the route's own bound.
    best = ranked(candidates, ["question_id", "_key"], most).where(F.col("rank") <= F.col("n"))
    return best.select("question_id", F.col("_key").alias("domain"), "rank", "id", "score")


def knn_multi_domain(corpus: DataFrame, routes: DataFrame, k: int = 5, **options) -> DataFrame:
    """For m domains per question take the nearest max(1, ceil(k / m)) of each, merge, keep the k nearest.

    `routes` holds (question_id, q, domain).
    """
    per_question = routes.groupBy("question_id").agg(F.count("*").alias("m"))
    quota = F.greatest(F.lit(1), F.ceil(F.lit(k) / F.col("m"))).cast("int")
    merged = knn_routed(corpus, routes.join(per_question, "question_id").withColumn("n", quota), **options)
    return ranked(merged.drop("rank"), ["question_id"], k).select("question_id", "rank", "id", "domain", "score")


def fit_cells(corpus: DataFrame, cells: int, vector: str = "embedding", seed: int = SEED, iterations: int = 10):
    """Cell centres of an approximate index: k-means on the corpus vectors."""
    points = corpus.where(F.col(vector).isNotNull()).select(
        array_to_vector(F.col(vector).cast("array<double>")).alias("features")
    )
    if cells < 2:
        return np.array([points.agg(Summarizer.mean(points["features"]).alias("mean")).first()["mean"].toArray()])
    model = KMeans(k=cells, seed=seed, maxIter=iterations).fit(points)
    return np.array(model.clusterCenters(), dtype=np.float64)
