"""Scalar expressions: blanks, keys, flags, durations, exact averages, display text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text that stands for NULL inside a hashed key, and in bronze files.
KEY_NULL_TEXT = "_dbt_utils_surrogate_key_null_"
FILE_NULL_TEXT = "NULL"

# Result bands of a finishing position, lowest bound first.
BAND_WIN = "P1"
BAND_PODIUM = "Podium (P2-P3)"
BAND_POINTS = "Points (P4-P10)"
BAND_OUTSIDE = "Outside points"
BAND_NONE = "DNF / DNS"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(col(value), F.lit(""))


def sentinel_to_null(value: Column | str) -> Column:
    return F.nullif(col(value), F.lit(FILE_NULL_TEXT))


def surrogate_key(columns: Sequence[Column | str]) -> Column:
    """md5 over the dash-joined text of the columns; NULL has its own text."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(KEY_NULL_TEXT)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def flag(condition: Column) -> Column:
    """A condition that is false, not unknown, for NULL input."""
    return F.coalesce(condition, F.lit(False))


def full_name(first: Column | str, last: Column | str) -> Column:
    """NULL when either part is NULL."""
    return F.concat(col(first), F.lit(" "), col(last))


def composite_text_key(left: Column | str, right: Column | str) -> Column:
    return F.concat(col(left).cast("string"), F.lit("_"), col(right).cast("string"))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def exact_avg(value: Column | str, precision: int, scale: int) -> Column:
    """Average of whole numbers, rounded half up once.

    The 14 fractional digits of the inner average keep the second rounding exact
    for groups of up to 10**12 rows.
    """
    return F.avg(col(value).cast("decimal(20,10)")).cast(f"decimal({precision},{scale})")


def duration_ms(value: Column | str) -> Column:
    """``H:MM:SS.mmm``, ``M:SS.mmm`` or ``S.mmm`` to milliseconds; other text to NULL."""
    parts = F.transform(F.split(col(value), ":"), lambda part: part.try_cast("decimal(20,6)"))
    seconds = F.aggregate(
        parts,
        F.lit(0).cast("decimal(28,6)"),
        lambda total, part: (total * 60 + part).cast("decimal(28,6)"),
    )
    return F.round(seconds * 1000, 0).cast("bigint")


def strip_zulu(value: Column | str) -> Column:
    return F.regexp_replace(col(value), "Z$", "")


def clock_text(value: Column | str) -> Column:
    """A time of day as ``HH:mm:ss`` text; text that is no time fails the query."""
    text = col(value)
    valid = text.rlike("^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$")
    return F.when(text.isNull(), F.lit(None).cast("string")).when(valid, text).otherwise(
        F.raise_error(F.concat(F.lit("not a time of day: "), text)).cast("string")
    )


def first_match(text: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Label of the first rule with a case-insensitive pattern that matches."""
    chain = F
    for label, patterns in rules:
        hit = col(text).ilike(patterns[0])
        for pattern in patterns[1:]:
            hit = hit | col(text).ilike(pattern)
        chain = chain.when(hit, F.lit(label))
    return chain.otherwise(F.lit(default))


def finish_band(position: Column | str) -> Column:
    p = col(position)
    return (
        F.when(p == 1, BAND_WIN)
        .when(p <= 3, BAND_PODIUM)
        .when(p <= 10, BAND_POINTS)
        .when(p.isNotNull(), BAND_OUTSIDE)
        .otherwise(BAND_NONE)
    )


def tolerant_number(value: Column | str, to: str = "double") -> Column:
    """NULL instead of an error for text that is no number."""
    return col(value).try_cast(to)


def display_text(value: Column | str, missing: str = "N/A") -> Column:
    return F.coalesce(col(value).cast("string"), F.lit(missing))
