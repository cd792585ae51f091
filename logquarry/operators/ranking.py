"""Sorting, top-k, exact order statistics and running totals without a single-task sort."""

from __future__ import annotations

import struct
from collections.abc import Callable
from math import ceil, floor

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.fixed_values import CORPUS_TAIL, TEST_SIZE

# `select_ranks` looks at so many of the bits of an order key in one pass.
KEY_BITS = 64
RADIX_BITS = 16


def sort_by_time(df: DataFrame, column: str = "timestamp", *tie_breakers: str) -> DataFrame:
    return df.orderBy(column, *tie_breakers)


def last_n_rows(df: DataFrame, keys: list[str], n: int = CORPUS_TAIL) -> DataFrame:
    """The n rows with the greatest keys: a per-partition top-n and one small merge, no full sort."""
    return df.orderBy(*[F.desc(k) for k in keys]).limit(n)


def topk_per_group(df: DataFrame, group: list[str], order: list, k: int | Column, rank: str = "rank") -> DataFrame:
    """First k rows of each group. Spark cuts each map task's groups to k before the shuffle when k is constant."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col(rank) <= k)


def _order_key(value: Column, kind: str) -> Column:
    """A long that sorts as the value does: whole numbers are themselves, doubles their bits with negative ones turned."""
    if kind == "bigint":
        return value.cast("bigint")
    # Adding 0 makes -0.0 and 0.0 one value; a missing value never gets here.
    number = F.coalesce(value.cast("double"), F.lit(0.0)) + F.lit(0.0)
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), number).cast("bigint")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(2**63 - 1)))


def _value_of(key: int, kind: str) -> float:
    if kind == "bigint":
        return key
    return struct.unpack("<d", struct.pack("<q", key if key >= 0 else key ^ (2**63 - 1)))[0]


def select_ranks(df: DataFrame, columns: list[str], ranks_of: Callable[[int], list[int]]) -> dict[str, tuple[int, dict[int, float]]]:
    """Exact values at zero-based sorted positions, for several numeric columns at once.

    `ranks_of(n)` names the positions wanted among a column's n non-missing values; the result maps each column to
    (n, {position: value}); columns without values are absent. Values become 64-bit keys of the same order. A pass
    counts them by their leading 16 bits, which shows in which bucket a position lies; the next pass counts only those
    buckets' values by the next 16 bits. Four passes decide any position whatever the values, and a bucket of one value
    ends earlier. No task sorts or ranks values, repeated ones cost nothing, a window holds at most 65,536 counts, and
    what reaches the driver is a few numbers per column and pass.
    """
    kinds = {c: "bigint" if t in ("tinyint", "smallint", "int", "bigint") else "double" for c, t in df.select(*[f"`{c}`" for c in columns]).dtypes}
    floating = {c for c, t in df.dtypes if t in ("double", "float")}
    known = {c: F.col(f"`{c}`").isNotNull() & (~F.isnan(f"`{c}`") if c in floating else F.lit(True)) for c in columns}
    keys = df.select(*[F.when(known[c], _order_key(F.col(f"`{c}`"), kinds[c])).alias(c) for c in columns])
    counted = df.agg(*[F.count(F.when(known[c], 1)).alias(c) for c in columns]).first()
    # Positions still open: per column and leading bits (all values at first), the position among those values.
    still: dict[str, dict[int | None, dict[int, int]]] = {c: {None: {r: r for r in ranks_of(counted[c])}} for c in columns if counted[c]}
    found: dict[str, tuple[int, dict[int, float]]] = {c: (counted[c], {}) for c in still}
    for shift in range(KEY_BITS - RADIX_BITS, -1, -RADIX_BITS):
        if not still:
            break
        narrower: dict[str, dict[int | None, dict[int, int]]] = {}
        for row in _bucket_counts(keys, still, shift).collect():
            name, below = row["feature"], row["through"] - row["count"]
            parent = None if shift + RADIX_BITS == KEY_BITS else row["prefix"] >> RADIX_BITS
            for rank, local in still[name][parent].items():
                if not below <= local < row["through"]:
                    continue
                if row["low"] == row["high"]:
                    found[name][1][rank] = _value_of(row["low"], kinds[name])
                else:
                    narrower.setdefault(name, {}).setdefault(row["prefix"], {})[rank] = local - below
        still = narrower
    return found


def _bucket_counts(keys: DataFrame, still: dict, shift: int) -> DataFrame:
    """Of the buckets with the next bits, those that hold an open position: (feature, prefix, count, low, high, through)."""
    top = shift + RADIX_BITS == KEY_BITS
    cells, hit = [], F.lit(False)
    for name, parents in still.items():
        key = F.col(f"`{name}`")
        inside = key.isNotNull() if top else F.shiftright(key, shift + RADIX_BITS).isin([*parents])
        cells.append(F.when(inside, F.struct(F.lit(name).alias("feature"), F.shiftright(key, shift).alias("prefix"), key.alias("key"))))
        for parent, ranks in parents.items():
            of = (F.col("feature") == name) & (F.lit(True) if top else F.col("parent") == parent)
            for local in set(ranks.values()):
                hit = hit | (of & (F.col("through") > local) & (F.col("through") - F.col("count") <= local))
    rows = keys.select(F.explode(F.filter(F.array(*cells), lambda cell: cell.isNotNull())).alias("cell"))
    counts = rows.groupBy("cell.feature", "cell.prefix").agg(F.count(F.lit(1)).alias("count"), F.min("cell.key").alias("low"), F.max("cell.key").alias("high"))
    counts = counts.withColumn("parent", F.lit(0).cast("bigint") if top else F.shiftright("prefix", RADIX_BITS))
    through = F.sum("count").over(Window.partitionBy("feature", "parent").orderBy("prefix"))
    return counts.withColumn("through", through).where(hit)


def exact_quantiles(df: DataFrame, columns: list[str], probability: float) -> dict[str, float]:
    """Exact linearly interpolated quantile per column (0.5 is the median); columns without values are absent."""

    def neighbours(n: int) -> list[int]:
        position = probability * (n - 1)
        return sorted({floor(position), ceil(position)})

    result = {}
    for name, (n, ranked) in select_ranks(df, columns, neighbours).items():
        position = probability * (n - 1)
        low, high = float(ranked[floor(position)]), float(ranked[ceil(position)])
        share = position - floor(position)
        result[name] = high - (high - low) * (1 - share) if share >= 0.5 else low + (high - low) * share
    return result


def temporal_split(
    df: DataFrame, column: str = "timestamp", tie_breakers: list[str] = (), test_size: float = TEST_SIZE
) -> DataFrame:
    """Add `is_train`: true for the first `int(n * (1 - test_size))` rows in time order, clamped to [1, n - 1].

    The cut row is found by exact selection, so the rows themselves are only compared with a constant and
    never sorted or numbered. `column` and `tie_breakers` (times or numbers) must tell all rows apart.
    """
    keys = [column, *tie_breakers]
    times = {k for k, t in df.dtypes if t in ("timestamp", "timestamp_ntz", "date")}
    # Rows without a time come last.
    as_number = {
        k: F.coalesce(F.unix_micros(F.col(k).cast("timestamp")), F.lit(2**63 - 1)) if k in times else F.col(k)
        for k in keys
    }
    numbers = df.select(*[as_number[k].alias(k) for k in keys])
    n = numbers.count()
    if n == 0:
        return df.withColumn("is_train", F.lit(True))
    rank = max(1, min(int(n * (1 - test_size)), n - 1))
    if rank >= n:
        return df.withColumn("is_train", F.lit(True))
    # The row at `rank` opens the test part: walk the keys until it is the first of its ties.
    is_train, tied = F.lit(False), F.lit(True)
    for key in keys:
        cut = select_ranks(numbers, [key], lambda _: [rank])[key][1][rank]
        is_train = is_train | (tied & (as_number[key] < cut))
        tied = tied & (as_number[key] == cut)
        rank -= numbers.where(F.col(key) < cut).count()
        numbers = numbers.where(F.col(key) == cut)
        if rank == 0:
            return df.withColumn("is_train", is_train)
    raise ValueError(f"Rows are tied on {keys} at the cut; add a tie-breaker that tells them apart")


def with_running_totals(
    df: DataFrame, order: str, sums: dict[str, str], buckets: int | None = None, bounds_of: DataFrame | None = None
) -> DataFrame:
    """Add, for each `sums[name]`, column `name`: the total of that column over all rows with a smaller `order`.

    `order` must be numeric and unique, e.g. after grouping by it. Rows are cut into value ranges at constant
    bounds, ranges are totalled, and each range is scanned on its own: no task sees more than one range. The
    bounds are quantiles of `order` in `bounds_of` (default `df`), e.g. the rows before they were grouped.
    """
    session = df.sparkSession
    buckets = buckets or int(session.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_order", F.col(order).cast("double"))
    bounds = []
    if buckets > 1:
        source = keyed.select("_order") if bounds_of is None else bounds_of.select(F.col(order).cast("double").alias("_order"))
        bounds = source.approxQuantile("_order", [i / buckets for i in range(1, buckets)], min(1e-3, 0.5 / buckets))
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    if len(splits) > 2:
        cutter = Bucketizer(splits=splits, inputCol="_order", outputCol="_range", handleInvalid="skip")
        keyed = cutter.transform(keyed)
    else:
        keyed = keyed.withColumn("_range", F.lit(0.0))
    # One row per range: at most `buckets` rows, so this window and the broadcast are bounded.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = keyed.groupBy("_range").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    ranges = ranges.select(
        "_range", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums]
    )
    inside = Window.partitionBy("_range").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.join(F.broadcast(ranges), "_range")
        .withColumns({n: F.col(f"_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()})
        .drop("_range", "_order", *[f"_{n}" for n in sums])
    )
