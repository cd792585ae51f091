"""Column expressions for cleaning, privacy, calendar and rule columns. All stay in the JVM."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from logquarry.fixed_values import (
    OFF_HOURS, OTHER_SERVICE, RISK_HIGH, RISK_NORMAL, RISK_THRESHOLD, SERVICE_RULES, WHITESPACE,
)


def strip(column: Column) -> Column:
    """Drop Unicode white space at both ends."""
    return F.trim(column, F.lit(WHITESPACE))


def parse_utc(column: Column, fmt: str | list[str] | None = None) -> Column:
    """Text to UTC time; whatever does not parse is NULL. One `fmt` accepts that format only, of several the first
    that fits counts, and an empty one among them stands for ISO texts."""
    formats = [fmt] if isinstance(fmt, str) or fmt is None else fmt
    parsed = F.coalesce(*[F.try_to_timestamp(column, F.lit(f)) if f else F.try_to_timestamp(column) for f in formats])
    return parsed.cast("timestamp_ntz")


def hash_user(column: Column) -> Column:
    """SHA-256 hex of the id as text. Ids are hashed as written in the log, never as parsed numbers."""
    return F.sha2(column.cast("string"), 256)


def mask_ip(column: Column) -> Column:
    """`a.b.***.***` for four dotted parts, `***` for anything else, NULL for NULL."""
    dots = F.length(column) - F.length(F.replace(column, F.lit("."), F.lit("")))
    masked = F.concat(F.substring_index(column, ".", 2), F.lit(".***.***"))
    return F.when(column.isNull(), None).when(dots == 3, masked).otherwise(F.lit("***"))


def fill_unknown(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("unknown"))


def time_bucket(column: Column, grain: str = "minute") -> Column:
    return F.date_trunc(grain, column).cast("timestamp_ntz")


def clock(column: Column) -> Column:
    return F.date_format(column, "HH:mm")


def is_weekend(column: Column) -> Column:
    return F.when(F.weekday(column) >= 5, 1).otherwise(0)


def calendar_parts(column: Column) -> dict[str, Column]:
    return {
        "hour": F.hour(column),
        "minute": F.minute(column),
        "hora_completa": clock(column),
        "day_of_week": F.weekday(column),
        "is_weekend": is_weekend(column),
    }


def cyclic_calendar_features(column: Column) -> dict[str, Column]:
    angle = F.lit(2.0) * F.pi() * F.hour(column) / F.lit(24)
    return {
        "year": F.year(column),
        "month": F.month(column),
        "day": F.day(column),
        "hour": F.hour(column),
        "day_of_week": F.weekday(column),
        "is_weekend": is_weekend(column),
        "hour_sin": F.sin(angle),
        "hour_cos": F.cos(angle),
    }


def classify_service(column: Column, rules=SERVICE_RULES, other: str = OTHER_SERVICE) -> Column:
    """First service with a prefix of the event name, white space in front ignored."""
    name = F.ltrim(F.coalesce(column, F.lit("")), F.lit(WHITESPACE))
    result = None
    for service, prefixes in rules:
        matches = reduce(or_, [name.startswith(prefix) for prefix in prefixes])
        result = F.when(matches, service) if result is None else result.when(matches, service)
    return result.otherwise(other)


def off_hours_flag(hour: Column, hours=OFF_HOURS) -> Column:
    return hour.isin(hours)


def risk_level(score: Column, threshold: float = RISK_THRESHOLD) -> Column:
    return F.when(score > threshold, RISK_HIGH).otherwise(RISK_NORMAL)


def normalize_boolean(column: Column) -> Column:
    """1 for the texts true and 1, else 0."""
    return F.when(F.lower(strip(column.cast("string"))).isin("true", "1"), 1).otherwise(0)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """0 for a zero denominator, for infinity and for NULL."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    finite = F.when(F.isnan(ratio) | (F.abs(ratio) == float("inf")), None).otherwise(ratio)
    return F.coalesce(finite, F.lit(0.0))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator where the denominator is positive, else 0; a NULL numerator counts as 0."""
    top = F.coalesce(numerator.cast("double"), F.lit(0.0))
    return F.when(
        F.coalesce(denominator.cast("double"), F.lit(0.0)) > 0, top / denominator.cast("double")
    ).otherwise(0.0)


def float_text(column: Column) -> Column:
    """Shortest decimal text of a double: `4e-06`, `0.0001`, `12.5`, `10000000.0`, `1e+16` (exponents under 1e-4 and from 1e16)."""
    java = column.cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(java, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    exponent = F.lpad(F.regexp_extract(java, r"E-([0-9]+)$", 1), 2, "0")
    scientific = F.concat(mantissa, F.lit("e-"), exponent)
    # Java turns to exponents below 1e-3 already: spell 1e-4 <= |x| < 1e-3 out.
    digits = F.regexp_replace(F.regexp_extract(java, r"^-?([0-9.]+)E", 1), r"\.0$|\.", "")
    spelled = F.concat(F.when(column < 0, "-").otherwise(""), F.lit("0.000"), digits)
    # Java turns to exponents from 1e7 already; the decimal of its text has the same digits.
    plain = F.regexp_replace(F.regexp_replace(java.cast("decimal(38,15)").cast("string"), "0+$", ""), r"\.$", ".0")
    large = F.concat(mantissa, F.lit("e+"), F.regexp_extract(java, r"E([0-9]+)$", 1))
    return (
        F.when(~java.contains("E"), java)
        .when(~java.contains("E-"), F.when(F.abs(column) < 1e16, plain).otherwise(large))
        .when(F.abs(column) < 1e-4, scientific)
        .otherwise(spelled)
    )
