"""Shared helpers: stored intermediate tables, checked broadcasts, row keys, connected components."""

from __future__ import annotations

import ctypes
import functools
import gc
import time
from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.session import shared_dir

# Python workers get rows in batches of this size: texts can be long, and every batch is held several times over, as
# bytes on both sides and as Python strings.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2 * 1024 * 1024),
}
# A side of a join is broadcast up to this many rows, and this many numbers in their arrays, counted first; beyond it both
# sides are shuffled.
BROADCAST_ROWS = 200_000
BROADCAST_ITEMS = 2_000_000
# Bytes of input from which shuffle files are deleted between steps.
LARGE_INPUT = 64 * 1024 * 1024


def bounded_batches(spark: SparkSession) -> None:
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)


def give_back() -> None:
    """Hand freed memory back to the machine: Python workers outlive their tasks, and stages that follow need the space."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass  # another C library than glibc


def thrifty(of: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function over a task's batches, giving memory back when the task ends."""

    @functools.wraps(of)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from of(batches)
        finally:
            give_back()

    return run


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the cluster's shared folder and read back: later stages start from the files."""
    path = shared_dir(df.sparkSession, f"{name}-{uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(source: DataFrame) -> None:
    """Let Spark delete the shuffle files of finished steps over `source`: it does so once the driver has collected what refers to
    them, which an idle driver may put off until the disks are full. Little input leaves little to delete."""
    spark = source.sparkSession
    if source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < LARGE_INPUT:
        return
    for pause in (0.2, 0):
        # What a finished step leaves goes in two rounds.
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, items: Column | None = None) -> DataFrame:
    """`df` marked for broadcast if it has at most `rows` rows, and BROADCAST_ITEMS `items` (a number per row) altogether
    where rows hold arrays. `df` should be stored, as it is counted here."""
    small = df.limit(rows + 1).count() <= rows
    if small and items is not None:
        small = (df.agg(F.sum(items)).first()[0] or 0) <= BROADCAST_ITEMS
    return F.broadcast(df) if small else df


def whole_row(df: DataFrame) -> Column:
    """All columns of `df` as one struct column `row`, so that no name of theirs can clash with a working column."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def columns_of(df: DataFrame, **replaced: Column) -> list[Column]:
    """The columns of `df` out of the struct column `row`, those named replaced."""
    return [replaced[c].alias(c) if c in replaced else F.col("row").getField(c).alias(c) for c in df.columns]


def salted_join(left: DataFrame, right: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join to a per-key table `right`: broadcast when that is small, else shuffled (adaptive execution splits hot keys)."""
    return left.join(small_side(right), on, how)


def binary_order(value: Column) -> Column:
    """Sort key that puts texts in code point order and nulls last."""
    return value.asc_nulls_last()


def connected_components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """Smallest node each node is linked to, as rows (id, component); nodes without an edge to another are absent.

    `edges` has columns src and dst of one orderable type; direction, repeats and loops don't matter, null ends are no
    edge. Every round hangs each node's larger neighbours below its smallest one and then each node's smaller
    neighbours below the smallest of them, until every node points at its root. Groupings keep only a minimum per node,
    so a hub costs a join that adaptive execution can split; each round is a stored table and nothing is collected.
    """
    current = stored(
        edges.where(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct(),
        name,
    )
    state = _state(current)
    for _ in range(rounds):
        if state[0] == 0:
            break
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(lowest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        current = stored(small.union(lowest.select("u", F.col("low").alias("v"))).distinct(), name)
        before, state = state, _state(current)
        if state == before:
            break
    else:
        raise RuntimeError(f"Components did not settle in {rounds} rounds")
    members = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.union(current.select("v", "v").distinct())


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges: equal states mean that a round changed nothing."""
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
    ).first()
    return tuple(row)
