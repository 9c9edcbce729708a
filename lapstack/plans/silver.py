"""Typed tables: one declarative projection per bronze table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.functions.scalars import blank_to_null, clock_text, first_match
from lapstack.schemas import SILVER_FIELDS, STATUS_DEFAULT, STATUS_RULES, Field

LOADED_AT = "dbt_loaded_at"


def typed_column(field: Field) -> Column:
    text = F.col(f"`{field.source}`")
    if field.blank_is_null:
        text = blank_to_null(text)
    if field.type == "clock":
        return clock_text(text).alias(field.out)
    return text.cast(field.type).alias(field.out)


def typed_projection(df: DataFrame, fields: Sequence[Field], loaded_at: Column | None = None) -> DataFrame:
    """Strict casts: a text that does not fit its type fails the query."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    return df.select(*[typed_column(f) for f in fields], stamp.alias(LOADED_AT))


def classify_status(
    df: DataFrame,
    text: str = "status",
    out: str = "status_category",
    rules: Sequence[tuple[str, Sequence[str]]] = STATUS_RULES,
    default: str = STATUS_DEFAULT,
) -> DataFrame:
    return df.withColumn(out, first_match(text, rules, default))


def silver_table(name: str, bronze: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    _, fields = SILVER_FIELDS[name]
    typed = typed_projection(bronze, fields, loaded_at)
    return classify_status(typed) if name == "dim_status" else typed
