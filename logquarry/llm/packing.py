"""Best-fit-decreasing packing of token ids into rows of one length.

Texts become token ids; documents longer than a row are split into pieces without loss. Pieces are dealt by hash over
shards of bounded size; within a shard the longest piece goes first, each into the fullest row that still has room, which
a segment tree over remaining capacities finds in a logarithm of the row length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.bpe import PATTERN, parse_ranks, read_ranks

ROW_TOKENS = 2048
# The vocabulary's free id.
PAD = 50_256
# Characters whose tokens make up one shard on average: it is packed by one task in memory.
SHARD_CHARS = 8_000_000

PACKS = (
    "shard int, pack int, n_tokens int, ids binary, position_ids binary, cu_seqlens array<int>, "
    "doc_ids array<bigint>, pieces array<int>"
)


class CapacityTree:
    """Rows by remaining capacity; finds the least capacity of at least a given size that some row has."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, row: int) -> None:
        heapq.heappush(self.rows[capacity], row)
        self._count(capacity, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove the first row among those with the least sufficient capacity; its capacity and number."""
        node = self.leaves + size
        if not self.counts[node]:
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.counts[node]:
                    node += 1
        capacity = node - self.leaves
        self._count(capacity, -1)
        return capacity, heapq.heappop(self.rows[capacity])

    def _count(self, capacity: int, change: int) -> None:
        node = self.leaves + capacity
        while node:
            self.counts[node] += change
            node >>= 1


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Rows of positions in `sizes`; longest first, equal sizes in the order given, each into the fullest row it fits.

    Of equally full rows the first opened is taken. Every size must be from 1 to `capacity`.
    """
    tree, rows = CapacityTree(capacity), []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[item])
        if found is None:
            left, row = capacity, len(rows)
            rows.append([])
        else:
            left, row = found
        rows[row].append(item)
        if left > sizes[item]:
            tree.add(left - sizes[item], row)
    return rows


def token_pieces(docs: DataFrame, row_tokens: int = ROW_TOKENS, ranks: bytes | None = None) -> DataFrame:
    """Rows (doc_id, piece, n, ids): each whole text's token ids, cut after every `row_tokens`; ids are 16 bits each.

    Null and empty texts have no tokens and so no pieces.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks or read_ranks())

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=parse_ranks(shared.value), special_tokens={})
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encoding.encode_to_numpy(text or "", disallowed_special=()).astype("<u2")
                for piece, start in enumerate(range(0, len(ids), row_tokens)):
                    part = ids[start : start + row_tokens]
                    rows.append((doc_id, piece, len(part), part.tobytes()))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "n", "ids"])
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInPandas(of, "doc_id long, piece int, n int, ids binary")


def packed(docs: DataFrame, row_tokens: int = ROW_TOKENS, pad: int = PAD, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """One row per packed row: ids padded to `row_tokens` and position ids that start at 0 in every piece (both as
    little-endian 16-bit numbers), the cumulative lengths of its pieces, and which document pieces they are.

    A shard holds the pieces of one value of a hash over doc_id, piece number and ids, so neither a hot source nor one
    long document fills a shard; its rows depend on the documents only, not on their order or partitions. Null doc_ids
    and repeated rows are packed like others; other columns are ignored; an empty table gives no rows.
    """
    if not 0 < row_tokens <= 65_536:
        raise ValueError("Position ids have 16 bits: rows of 1 to 65,536 tokens")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-chars // shard_chars))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "ids"), F.lit(shards)).cast("int")

    def pack(table: pa.Table) -> pa.Table:
        frame = table.to_pandas()
        frame = frame.sort_values(["doc_id", "piece", "ids"], kind="stable", na_position="last").reset_index(drop=True)
        sizes = frame["n"].tolist()
        names = [f.split()[0] for f in PACKS.split(", ")]
        columns: dict[str, list] = {n: [] for n in names}
        ids, docs_of, piece_of = frame["ids"].tolist(), table_ids(frame["doc_id"]), frame["piece"].tolist()
        number = int(frame["shard"].iloc[0])
        for pack_no, items in enumerate(best_fit_decreasing(sizes, row_tokens)):
            lengths = np.array([sizes[i] for i in items])
            total = int(lengths.sum())
            positions = np.concatenate([np.arange(n) for n in lengths] + [np.zeros(row_tokens - total)])
            padding = np.full(row_tokens - total, pad, dtype="<u2").tobytes()
            values = (
                number, pack_no, total, b"".join([ids[i] for i in items]) + padding, positions.astype("<u2").tobytes(),
                [0, *np.cumsum(lengths).tolist()], [docs_of[i] for i in items], [piece_of[i] for i in items],
            )
            for name, value in zip(names, values):
                columns[name].append(value)
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.table([pa.array(columns[n], type=t) for n, t in zip(names, types)], names=names)

    def table_ids(column: pd.Series) -> list:
        return [None if pd.isna(x) else int(x) for x in column]

    pieces = token_pieces(docs, row_tokens).withColumn("shard", shard)
    return pieces.groupBy("shard").applyInArrow(pack, PACKS)


def write_packed(packs: DataFrame, folder: str) -> None:
    """Id and position matrices as Parquet, one row of the matrix per record, in folders by shard."""
    packs.write.mode("overwrite").partitionBy("shard").parquet(folder)


def matrix(column: list[bytes]) -> np.ndarray:
    """Rows of `ids` or `position_ids` as one array."""
    return np.stack([np.frombuffer(row, dtype="<u2") for row in column])
