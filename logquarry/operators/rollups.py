"""Totals at several grains at once, and distinct counts that can be merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Registers of a sketch are 2^LOG_REGISTERS; the relative standard error is 1.04 over their root.
LOG_REGISTERS = 12
USAGE_SETS = (("day", "service"), ("day", "user_hash"), ("day",), ("service",), ("user_hash",), ())


def usage_rollup(counts: DataFrame, sets=USAGE_SETS) -> DataFrame:
    """(day, service, user_hash, level, requests, cells) of a `count_events` table for every grouping set; columns a set
    leaves out are null, `level` names its columns, `cells` are the (day, service, user) combinations behind a total.

    Counts are summed per (day, service, user) first, so the rows that the sets multiply are those combinations, not
    minutes; the totals over everything are summed up in the map tasks.
    """
    columns = ["day", "service", "user_hash"]
    daily = counts.groupBy(F.to_date("bucket").alias("day"), "service", "user_hash").agg(F.sum("requests").alias("requests"))
    chosen = [[F.col(c) for c in one] for one in sets]
    totals = daily.groupingSets(chosen, *[F.col(c) for c in columns]).agg(
        F.sum("requests").alias("requests"), F.count(F.lit(1)).alias("cells"), F.grouping_id().alias("gone")
    )
    names = {sum(2 ** (2 - i) for i, c in enumerate(columns) if c not in one): "+".join(one) or "all" for one in sets}
    level = F.lit(None).cast("string")
    for gone, name in names.items():
        level = F.when(F.col("gone") == gone, name).otherwise(level)
    return totals.select(*columns, level.alias("level"), "requests", "cells")


def user_sketches(counts: DataFrame) -> DataFrame:
    """(bucket, service, requests, users): per minute and service the requests and a sketch of the users, to be stored with
    the marts. A sketch has at most 2^LOG_REGISTERS registers, however many users there are."""
    return counts.groupBy("bucket", "service").agg(
        F.sum("requests").alias("requests"), F.hll_sketch_agg("user_hash", LOG_REGISTERS).alias("users")
    )


def merged_users(sketches: DataFrame, *keys) -> DataFrame:
    """Stored sketches at a coarser grain: `keys`, requests, unique_users (estimated). No event is read again."""
    return sketches.groupBy(*keys).agg(
        F.sum("requests").alias("requests"), F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_users")
    )
