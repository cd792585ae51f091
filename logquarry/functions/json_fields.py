"""Columns of JSON text: which fields they hold, chosen fields as typed columns, and what is not JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(column: str) -> Column:
    """The text as a variant; null where it is null or not JSON."""
    return F.try_parse_json(F.col(f"`{column}`"))


def is_bad_json(column: str) -> Column:
    """Whether a text is there that is not JSON."""
    return F.col(f"`{column}`").isNotNull() & parsed(column).isNull()


def json_quality(df: DataFrame, column: str) -> DataFrame:
    """One row: n_rows, n_null, n_bad. One aggregate over the column; a table without rows counts zeros."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(f"`{column}`").isNull()).alias("n_null"),
        F.count_if(is_bad_json(column)).alias("n_bad"),
    )


def discover_fields(df: DataFrame, column: str, depth: int = 3) -> DataFrame:
    """(path, type, n_rows): every field of the objects in the column down to `depth` levels, with its type and how often it
    is there. A field of several types has a row for each.

    Objects are opened level by level in the rows they stand in and only counted after that, so nothing but (path, type)
    counts is shuffled. Null and bad texts and values that are no objects have no fields; an empty table has none.
    """
    levels = [df.select(F.lit("$").alias("path"), parsed(column).alias("value")).where(F.col("value").isNotNull())]
    for _ in range(depth):
        # The generator opens arrays as well; only keys of objects are fields.
        opened = levels[-1].where(F.schema_of_variant("value").startswith("OBJECT")).alias("outer")
        inner = opened.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("outer.value").outer()).alias("inner"))
        levels.append(inner.select(F.concat("outer.path", F.lit("."), "inner.key").alias("path"), F.col("inner.value").alias("value")))
    kind = F.schema_of_variant("value")
    kind = F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(
        kind.startswith("DECIMAL") | (kind == "DOUBLE"), "number").otherwise(F.lower(kind))
    counts = [level.groupBy("path", kind.alias("type")).agg(F.count(F.lit(1)).alias("n_rows")) for level in levels[1:]]
    found = counts[0]
    for more in counts[1:]:
        found = found.unionByName(more)
    return found


def shred_fields(df: DataFrame, column: str, fields: dict[str, tuple[str, str]], bad: str | None = None) -> DataFrame:
    """`df` with a column per entry of `fields`, name to (path such as `$.a.b`, type); with `bad` a flag of that name for
    texts that are not JSON.

    Values that are missing or not of the type are null. The text is parsed once a row. Columns of `df` keep their names; one
    that a field is named after is an error.
    """
    clash = [name for name in [*fields, *([bad] if bad else [])] if name.lower() in map(str.lower, df.columns)]
    if clash:
        raise ValueError(f"Columns are there already: {clash}")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), parsed(column).alias("value"))
    chosen = [F.try_variant_get("value", path, kind).alias(name) for name, (path, kind) in fields.items()]
    text = F.col("row").getField(column)
    flag = [(text.isNotNull() & F.col("value").isNull()).alias(bad)] if bad else []
    return rows.select(*[F.col("row").getField(c).alias(c) for c in df.columns], *chosen, *flag)
