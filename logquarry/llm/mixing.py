"""Mixing sources to target weights by hash thresholds, without sorting documents.

Every document has a 60-bit hash. Per source, sizes are summed by the hash's leading bits; the running sum shows in which
bucket the source's budget ends, and only that bucket's documents are summed again by the next bits, until the bucket
is a single hash. Documents below the threshold are taken; a larger budget has a larger threshold, so samples nest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import columns_of, small_side, stored, whole_row

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
WORDS = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
LEVEL_BITS = 15


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of an md5 over the id and the text's md5, so rows without an id differ by text."""
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def _sized(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"), document_hash(F.col("doc_id"), text).alias("hash"),
    )


def _numbered(sources: DataFrame) -> DataFrame:
    """Zero-based place of each source in code point order, null last: ranges are numbered on their own and shifted."""
    partitions = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("source").asc_nulls_last()
    ranged = stored(sources.repartitionByRange(partitions, order).withColumn("part", F.spark_partition_id()), "mix-sources")
    # One row per range: at most the number of partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ranged.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.col("shift")
    return ranged.join(F.broadcast(shifts), "part").withColumn("place", place).drop("part", "shift")


def _level(weighed: DataFrame, budget: float, most: int) -> float:
    """The tokens per weight at which targets, none above `most` times its source's size, use up the budget."""
    cap = most * F.col("source_size")
    level = None
    while True:
        above = F.lit(False) if level is None else cap <= F.col("weight") * F.lit(level)
        used, weight = weighed.agg(F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        found = (budget - used) / weight if weight else float("inf")
        if found == level or not weight:
            return found
        level = found


def mixing_plan(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS
) -> tuple[DataFrame, DataFrame]:
    """The stored documents' sizes and hashes, and per source: source_size, target, repeats, upper.

    Sources in code point order (null last) have `weights` in turn and share `share` times all words; a target stops at
    `most` times its source's size and the excess is shared by weight among the rest. Each document is taken `repeats`
    times and once more if its hash is below `upper`; the threshold is the one whose words come nearest to the target.
    """
    sized = stored(_sized(docs), "mix-sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = stored(_numbered(sources).withColumn("weight", weight), "mix-weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = _level(weighed, share * total, most) if total else 0.0
    cap = (most * F.col("source_size")).cast("double")
    target = cap if level == float("inf") else F.least(cap, F.col("weight") * F.lit(float(level)))
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = weighed.withColumn("target", target).withColumn("repeats", F.least(repeats, F.lit(most).cast("long")))
    plan = plan.withColumn("rest", F.col("target") - F.col("repeats") * F.col("source_size"))
    thresholds = _thresholds(sized, plan.select("source", "rest"))
    plan = plan.join(small_side(thresholds), plan["source"].eqNullSafe(thresholds["key"]), "left")
    return sized, stored(plan.select("source", "source_size", "target", "repeats", F.coalesce("upper", F.lit(0).cast("long")).alias("upper")), "mix-plan")


def _thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """Rows (key, upper): per source the hash below which its documents' sizes come nearest to `rest`."""
    # `low` is the first hash of the bucket in which the budget ends, `rest` what is left of it there.
    ends = stored(budgets.where("rest > 0").select(F.col("source").alias("key"), F.lit(0).cast("long").alias("low"), "rest"), "mix-ends")
    rows, width = sized.select("source", "size", "hash"), 1 << HASH_BITS
    while width > 1:
        width >>= LEVEL_BITS
        bucket = F.col("low") + F.floor((F.col("hash") - F.col("low")) / width) * width
        open_ends = ends.select("key", "low", "rest")
        bound = rows.join(small_side(open_ends), rows["source"].eqNullSafe(F.col("key")))
        sums = bound.groupBy("key", "rest", bucket.cast("long").alias("bucket")).agg(F.sum("size").alias("size"))
        # At most 2 ** LEVEL_BITS buckets of a source in a window.
        running = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        summed = sums.withColumn("through", F.sum("size").over(running))
        reached = summed.where((F.col("through") >= F.col("rest")) & (F.col("through") - F.col("size") < F.col("rest")))
        left = (F.col("rest") - F.col("through") + F.col("size")).alias("rest")
        ends = stored(reached.select("key", F.col("bucket").alias("low"), left, "size"), "mix-ends")
        if width > 1:
            inside = rows.join(small_side(ends.select("key", "low")), rows["source"].eqNullSafe(F.col("key")))
            inside = inside.where((F.col("hash") >= F.col("low")) & (F.col("hash") < F.col("low") + width))
            rows = stored(inside.select("source", "size", "hash"), "mix-boundary")
    # The last bucket is one hash: it is taken if that comes nearer to the budget.
    return ends.select("key", F.when(2 * F.col("rest") >= F.col("size"), F.col("low") + 1).otherwise(F.col("low")).alias("upper"))


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    named = plan.select(*[F.col(c).alias(f"_mix_{c}") for c in plan.columns])
    return rows.join(small_side(named), rows["source"].cast("string").eqNullSafe(named["_mix_source"]))


def _times(hashed: Column) -> Column:
    return F.col("_mix_repeats") + F.when(hashed < F.col("_mix_upper"), 1).otherwise(0)


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per row of `docs`: doc_id, size in words, its source's size and target, and the words taken, repeats counted.

    A null text has size 0; null sources are one source; rows equal in doc_id and text share a hash and so a decision;
    other columns are ignored; an empty table gives no rows.
    """
    sized, plan = mixing_plan(docs, **options)
    return _with_plan(sized, plan).select(
        "doc_id", "size", F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
        (F.col("size") * _times(F.col("hash"))).alias("taken"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, all columns kept whatever their names.

    A null or empty text has size 0; it is taken as its hash says, and costs no words. Null sources are one source. No
    two documents tie but rows equal in doc_id and text, which are taken or left together; an empty table gives no rows.
    """
    _, plan = mixing_plan(docs, **options)
    hashed = document_hash(F.col("doc_id"), F.col("text").cast("string"))
    rows = docs.select(whole_row(docs), F.col("source").alias("source"), hashed.alias("hash"))
    times = F.array_repeat(F.lit(0), _times(F.col("hash")).cast("int"))
    return _with_plan(rows, plan).select("row", F.explode(times)).select(*columns_of(docs))
