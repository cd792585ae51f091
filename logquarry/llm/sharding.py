"""Sharding by a two-pass external shuffle, with DataFrame functions only.

First pass: every record goes to a bucket chosen by a seeded hash of where it stands in its file, so buckets fill evenly
whatever the records hold: equal texts, ids or sources are spread like any others. There are as many buckets as the table's
bytes ask for, so one fits into a task's memory. Second pass: each bucket is one task, which puts its records in a fixed
order and then shuffles them in memory (Spark's `shuffle` is a Fisher-Yates shuffle). The buckets one after the other are
a random order of the table; shards are equal ranges of it, so their counts are at most one apart.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import small_side, stored

SHARDS = 8
SEED = 20
# Bytes of records that one task shuffles in memory.
BUCKET_BYTES = 16 * 1024 * 1024
LAW = "rows"


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text and one more; a null text has none."""
    return (F.coalesce(F.octet_length(text.cast("string")), F.lit(0)) + 1).cast("long")


def _placed(records: DataFrame, size: Column, seed: int) -> DataFrame:
    """Rows (row, size, hash): the whole record, and a seeded hash of its file and place in it.

    Records that don't come straight from files are written first. So a task that runs again, or a second run over the
    same files, deals every record to the same bucket.
    """
    whole = [F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("row"), size.alias("size")]
    try:
        return _hashed(records.select(*whole, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")), seed)
    except AnalysisException:
        kept = stored(records.select(*whole), "shard-records")
        return _hashed(kept.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")), seed)


def _hashed(rows: DataFrame, seed: int) -> DataFrame:
    return rows.select("row", "size", F.xxhash64(F.lit(seed), "file", "at").alias("hash"))


def shuffled(records: DataFrame, size: Column, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Rows (row, place, total): every record as a struct, its place from 0 in a random order, and the number of records."""
    rows = _placed(records, size, seed)
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()["bytes"]
    buckets = max(1, -(-total // bucket_bytes))
    rows = rows.withColumn("bucket", F.pmod("hash", F.lit(buckets)).cast("int"))
    # One row per bucket.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy()).alias("total"))
    starts = small_side(stored(counts, "shard-buckets"))
    scattered = rows.select("bucket", F.struct("hash", "row").alias("record")).repartitionById(buckets, "bucket")
    gathered = scattered.groupBy("bucket").agg(F.collect_list("record").alias("records"))
    ordered = F.array_sort("records", lambda a, b: F.when(a["hash"] < b["hash"], -1).when(a["hash"] > b["hash"], 1).otherwise(0))
    mixed = gathered.select("bucket", F.shuffle(ordered, seed).alias("records"))
    each = mixed.select("bucket", F.posexplode("records").alias("within", "record"))
    return each.join(starts, "bucket").select("record.row", (F.col("start") + F.col("within")).cast("long").alias("place"), "total")


def _shard_of(place: Column, total: Column, shards: int) -> tuple[Column, Column]:
    """Shard and slot of a place: the first `total % shards` shards hold one record more."""
    least, more = F.floor(total / shards), total % shards
    wide = more * (least + 1)
    shard = F.when(place < wide, F.floor(place / (least + 1))).otherwise(more + F.floor((place - wide) / F.greatest(least, F.lit(1))))
    start = shard * least + F.least(shard, more)
    return shard.cast("int"), (place - start).cast("long")


def write_shards(
    records: DataFrame, path: str, shards: int = SHARDS, size: Column | None = None, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> None:
    """Write the records in random order as Parquet below `path`, one folder `shard=N` per shard that has any.

    A file holds the columns row (the whole record, so that no column name can clash) and slot, the record's place in its
    shard, gapless from 0; rows of a file follow their slots. Counts of shards are at most one apart. Null, empty and
    very long texts are records like others (`size` is `text_bytes` of `text` by default; a bucket is larger by at most
    its longest records); repeated rows are all kept and spread; records never tie, as their places differ; an empty table
    writes no shard. The same files, seed and sizes give the same shards.
    """
    places = shuffled(records, text_bytes(F.col("text")) if size is None else size, seed, bucket_bytes)
    shard, slot = _shard_of(F.col("place"), F.col("total"), shards)
    places.select("row", slot.alias("slot"), shard.alias("shard")).write.mode("overwrite").partitionBy("shard").parquet(path)


def read_shards(spark, path: str, record_type) -> DataFrame:
    """Rows (row, slot, shard) of what `write_shards` wrote of records of this type (a table's `schema`)."""
    from pyspark.sql.types import IntegerType, LongType, StructType

    schema = StructType().add("row", record_type).add("slot", LongType()).add("shard", IntegerType())
    return spark.read.schema(schema).parquet(path)


def shard_report(shards: DataFrame) -> DataFrame:
    """Per written record (row, slot, shard) of documents: doc_id, size, text_crc32 (of no bytes for null: 0), law, shard,
    slot, and grown_shard, which is null as this law is not `key`."""
    text = F.col("row.text").cast("string")
    return shards.select(
        F.col("row.doc_id").alias("doc_id"), text_bytes(text).alias("size"), F.coalesce(F.crc32(text), F.lit(0).cast("long")).alias("text_crc32"),
        F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
