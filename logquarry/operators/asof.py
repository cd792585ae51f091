"""Each row with the last row of another table that is not later: an as-of join without pairs."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logquarry.session import shared_dir


def as_of_join(
    left: DataFrame, right: DataFrame, on: list[str], time: str, matched: str = "matched", strict: bool = False, ranges: int | None = None
) -> DataFrame:
    """All rows of `left` and in the struct `matched` the row of `right` with equal `on` and the latest `time` that is not
    later (with `strict` earlier); null if there is none.

    Both tables are dealt together into ranges of (on, time), stored once, and every range is filled forwards by itself.
    What a range needs from those before it is the last right row of the one key it may begin amid, a row per range. So a
    key or a moment with many rows is shared by many tasks, and no pair is ever formed. Of right rows with equal key and
    time the greatest by its other columns counts. Null keys and times match nothing, repeated left rows stay, an empty
    right table matches nothing; columns of both tables may have equal names.
    """
    session = left.sparkSession
    ranges = ranges or int(session.conf.get("spark.sql.shuffle.partitions"))
    if matched in left.columns:
        raise ValueError(f"Column {matched} is there already")
    keys = [f"k{i}" for i in range(len(on))]

    def sided(df: DataFrame, side: int) -> DataFrame:
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        return df.select(row.alias("row"), *[F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)], F.col(f"`{time}`").alias("t"), F.lit(side).alias("side"))

    usable = F.col("t").isNotNull()
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    # At equal times right rows stand in front unless they have to be earlier.
    known = sided(right, 1 if strict else -1).where(usable)
    known = known.groupBy(*keys, "t", "side").agg(F.max("row").alias("known"))
    asked = sided(left, 0).withColumnRenamed("row", "own")
    columns = [*keys, "t", "side", "own", "known"]
    rows = asked.withColumn("known", F.lit(None).cast(known.schema["known"].dataType)).select(*columns).unionByName(
        known.withColumn("own", F.lit(None).cast(asked.schema["own"].dataType)).select(*columns)
    )
    # Left rows of one moment may stand in any order: a spread by place lets ranges cut amid them.
    rows = rows.withColumn("spread", F.when(F.col("side") == 0, F.monotonically_increasing_id() % 65_536).otherwise(0))
    order = ["t", "side", "spread"]
    path = shared_dir(session, f"as-of-{uuid4().hex}")
    rows.repartitionByRange(ranges, *keys, *order).withColumn("part", F.spark_partition_id()).write.parquet(path)
    dealt = session.read.schema(rows.withColumn("part", F.lit(0)).schema).parquet(path)
    # Only the first key of a range can have begun in an earlier one.
    key = F.struct(*keys)
    bounds = dealt.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    lasts = dealt.where("known IS NOT NULL").select("part", key.alias("key"), "t", "known")
    ends = bounds.join(lasts, "part").where(F.col("key") == F.col("last"))
    ends = ends.groupBy("part").agg(F.max_by(F.struct("key", "known"), "t").alias("carried"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = bounds.join(ends, "part", "left").withColumn("carried", F.last("carried", ignorenulls=True).over(before))
    carried = carried.select("part", F.when(F.col("carried.key") == F.col("first"), F.col("carried")).alias("carried"))
    filled = F.last("known", ignorenulls=True).over(Window.partitionBy("part", *keys).orderBy(*order))
    found = dealt.withColumn("filled", filled).where("own IS NOT NULL").join(F.broadcast(carried), "part")
    value = F.coalesce("filled", F.when(F.col("carried.key") == key, F.col("carried.known")))
    own = [F.col("own").getField(c).alias(c) for c in left.columns]
    return found.select(*own, F.when(usable, value).alias(matched))
