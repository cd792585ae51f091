"""Schema helpers that run while the plan is built; none of them starts a job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.fixed_values import COLUMN_ALIASES, LEAKAGE_COLUMNS

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "boolean")


def normalize_names(df: DataFrame, lower: bool = True) -> DataFrame:
    """Strip all column names, and lower-case them unless told not to."""
    return df.toDF(*[c.strip().lower() if lower else c.strip() for c in df.columns])


def drop_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with NULL in any of the columns that exist; the test reaches the Parquet scan."""
    for name in columns:
        if name in df.columns:
            df = df.where(F.col(name).isNotNull())
    return df


def resolve_aliases(df: DataFrame, aliases=COLUMN_ALIASES) -> DataFrame:
    """Rename the first alias that is present (any case) to each target that is absent (exact case)."""
    present = {c.lower(): c for c in df.columns}
    renames = {}
    for target, names in aliases.items():
        if target in df.columns:
            continue
        source = next((present[n] for n in names if n in present), None)
        if source is not None:
            renames[source] = target
    return df.withColumnsRenamed(renames) if renames else df


def with_default_columns(df: DataFrame, sources: dict[str, str], default: str = "unknown") -> DataFrame:
    """Copy `sources[target]` to each target; a target whose source column is missing is the literal default."""
    return df.withColumns(
        {
            target: F.col(source) if source in df.columns else F.lit(default)
            for target, source in sources.items()
        }
    )


def canonical_event_resource(df: DataFrame) -> DataFrame:
    return with_default_columns(df, {"event": "eventname", "resource": "resources"})


def select_present(df: DataFrame, required: list[str], optional: list[str]) -> DataFrame:
    """Required columns, then those optional ones that exist, in the given order."""
    return df.select(*required, *[c for c in optional if c in df.columns])


def drop_leakage_columns(df: DataFrame, columns=LEAKAGE_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def drop_all_null_signal(df: DataFrame, ignored=("timestamp", "dominant_event", "is_anomaly")) -> DataFrame:
    """Drop rows whose signal columns are all NULL."""
    return df.na.drop(how="all", subset=[c for c in df.columns if c not in ignored])


def split_columns_by_dtype(df: DataFrame, ignored=()) -> tuple[list[str], list[str]]:
    """(numeric or boolean, all other) column names."""
    numeric, other = [], []
    for name, dtype in df.dtypes:
        if name not in ignored:
            (numeric if dtype.split("(")[0] in NUMERIC_TYPES else other).append(name)
    return numeric, other
