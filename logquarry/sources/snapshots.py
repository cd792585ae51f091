"""Finding the snapshot of a dated table (`.../dt=YYYY-MM-DD/name.parquet`) to read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.sources.logs import scan_auto, scan_parquet


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob on any Hadoop file system: a listing, no data is read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in (found or []))


def remove_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def latest_snapshot_path(spark: SparkSession, base: str, domain: str, name: str) -> str | None:
    """Newest `name.parquet` or `name.csv`: first below `base/domain`, then anywhere below `base`.

    Newest is the lexicographic maximum of the path, so within one date Parquet wins over CSV.
    """
    for prefix in (f"{base}/{domain}/dt=*", f"{base}/*", f"{base}/*/*", f"{base}/*/*/*"):
        found = [p for kind in ("csv", "parquet") for p in matching_paths(spark, f"{prefix}/{name}.{kind}")]
        if found:
            return max(found)
    return None


def expected_or_last_path(spark: SparkSession, base: str, as_of: str, name: str = "cleaned_logs") -> str | None:
    """The snapshot of day `as_of` if it is there, else the last cleaned Parquet that is listed.

    Snapshots can be folders; the part files in them are none.
    """
    expected = matching_paths(spark, f"{base}/dt={as_of}/{name}.parquet")
    if expected:
        return expected[0]
    listed = [
        p
        for depth in ("", "/*", "/*/*")
        for p in matching_paths(spark, f"{base}{depth}/*.parquet")
        if ("silver" in p.lower() or "cleaned" in p.lower()) and not p.rsplit("/", 1)[0].lower().endswith(".parquet")
    ]
    return max(listed) if listed else None


def first_available_source(
    spark: SparkSession, domain: str, name: str, bases: list[str], schema: str | None = None
) -> DataFrame:
    """Read the newest snapshot from the first of `bases` that holds one."""
    for base in bases:
        path = latest_snapshot_path(spark, base, domain, name)
        if path:
            return scan_auto(spark, path, schema)
    raise FileNotFoundError(
        f"No dataset for domain={domain}, name={name} below {', '.join(bases)}: build the marts first "
        "or name the folder that holds them."
    )


def stored_days(spark: SparkSession, path: str) -> list[str]:
    """Days of a table partitioned by `dt`, oldest first: a listing of folders, no file is opened."""
    return [p.rsplit("dt=", 1)[1] for p in matching_paths(spark, f"{path}/dt=*")]


def read_day(spark: SparkSession, path: str, day: str) -> DataFrame:
    """Rows of one day of a table partitioned by `dt`; the day has to be there."""
    if day not in stored_days(spark, path):
        raise FileNotFoundError(f"No day {day} below {path}")
    return scan_parquet(spark, path).where(F.col("dt") == day).drop("dt")


def read_expected_or_last_day(spark: SparkSession, path: str, as_of: str | None = None) -> DataFrame:
    """Rows of day `as_of`, or of the newest day if that one is not there or not named."""
    days = stored_days(spark, path)
    if not days:
        raise FileNotFoundError(f"No dt=... folders below {path}")
    return read_day(spark, path, as_of if as_of in days else days[-1])


def latest_snapshot(df: DataFrame, column: str = "dt") -> DataFrame:
    """Rows of the newest snapshot of a table that carries its date in `column`.

    The maximum is a scalar subquery; on a table partitioned by `column` it prunes partitions at run time. For a
    stored table `read_expected_or_last_day` finds the day by listing folders instead.
    """
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def expected_or_last_snapshot(df: DataFrame, as_of: str, column: str = "dt") -> DataFrame:
    """Rows of day `as_of` if it has any, else of the newest day."""
    wanted = F.lit(as_of).cast(df.schema[column].dataType)
    chosen = df.agg(F.coalesce(F.max(F.when(F.col(column) == wanted, F.col(column))), F.max(column))).scalar()
    return df.where(F.col(column) == chosen)
