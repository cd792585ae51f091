"""Windows over a whole order without one task that sees all rows.

Rows are dealt into ranges of the order, as many as there are shuffle partitions; ties may be cut anywhere, so a moment
with many rows is shared by several ranges. Each range gets the last rows before it as well, its halo, and computes its
windows on its own; halo rows are dropped afterwards.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from logquarry.session import shared_dir

KEY = "timestamp"
# Names that no column of a table has.
PART, OWN = "range of the order", "row of this range"


def over_ranges(
    df: DataFrame, order: list[str], before: int, columns: Callable[[WindowSpec], dict[str, Column]], ranges: int | None = None
) -> DataFrame:
    """`df` with window columns that look at most `before` rows back in the order of the columns `order`.

    `columns` gets a window specification (ordered, without frame) and names the columns to add; it may set frames from
    `before` rows back up to the current row, or use `lag` up to `before`. Nulls come first in the order. Rows that tie
    in all of `order` may stand in any order, so name enough columns to tell rows apart; repeated rows are all kept. An
    empty table stays empty. The rows are written once in their ranges, so that a task that runs again finds the same.
    """
    session = df.sparkSession
    ranges = ranges or int(session.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"row.`{c}`").asc_nulls_first() for c in order]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    dealt = rows.repartitionByRange(ranges, *keys).withColumn("part", F.spark_partition_id())
    path = shared_dir(session, f"ranges-{uuid4().hex}")
    dealt.write.parquet(path)
    dealt = session.read.schema(dealt.schema).parquet(path)
    # The last rows of each range, numbered over all ranges: at most `before` rows per range.
    latest = Window.partitionBy("part").orderBy(*[F.col(f"row.`{c}`").desc_nulls_last() for c in order])
    tails = dealt.withColumn("back", F.row_number().over(latest)).where(F.col("back") <= before)
    tails = tails.withColumn("place", F.row_number().over(Window.orderBy("part", F.desc("back"))))
    # A range's halo are the `before` tail rows that stand before it, whichever ranges they come from.
    ends = tails.groupBy("part").agg(F.max("place").alias("end"))
    starts = ends.select("part", F.coalesce(F.lag("end").over(Window.orderBy("part")), F.lit(0)).alias("start"))
    wanted = starts.select(F.col("part").alias("reader"), F.explode(F.sequence(F.lit(0), F.lit(before - 1))).alias("k"), "start")
    wanted = wanted.where("start > k").select("reader", (F.col("start") - F.col("k")).alias("place"))
    halo = tails.join(F.broadcast(wanted), "place").select("row", F.col("reader").alias("part"), F.lit(False).alias("own")) if before else None
    every = dealt.select("row", "part", F.lit(True).alias("own"))
    every = every if halo is None else every.unionByName(halo)
    # Halo rows stand in front whatever the ties.
    window = Window.partitionBy(F.col(PART)).orderBy(F.col(OWN), *[F.col(f"`{c}`").asc_nulls_first() for c in order])
    flat = every.select(F.col("part").alias(PART), F.col("own").alias(OWN), *[F.col("row").getField(c).alias(c) for c in df.columns])
    return flat.withColumns(columns(window)).where(F.col(OWN)).drop(PART, OWN)


def request_trend(performance: DataFrame, over: int = 3, order: list[str] = (KEY,)) -> DataFrame:
    """A performance mart with `rolling_requests_<over>`, the mean of `requests` over a row and the ones before it, and
    `requests_growth_pct`, the change against the row before in percent (0 without one, or where it had no requests).

    These are the optional columns that the feature table takes up where it finds them.
    """

    def columns(window: WindowSpec) -> dict[str, Column]:
        requests, before = F.col("requests").cast("double"), F.lag(F.col("requests").cast("double")).over(window)
        growth = F.when(before > 0, 100.0 * (requests - before) / before).otherwise(0.0)
        return {f"rolling_requests_{over}": F.avg(requests).over(window.rowsBetween(1 - over, 0)), "requests_growth_pct": growth}

    return over_ranges(performance, list(order), over - 1, columns)
