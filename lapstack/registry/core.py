"""Registration of queries: output columns, the Spark side, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstack.plans.star import StarTables
from lapstack.registry.sql import with_views

_SQL_TYPES = {"long": "BIGINT", "double": "DOUBLE", "text": "VARCHAR", "flag": "BOOLEAN"}
_SPARK_TYPES = {"long": "bigint", "double": "double", "text": "string", "flag": "boolean"}


@dataclass(frozen=True)
class Query:
    columns: tuple[tuple[str, str], ...]
    plan: Callable[[StarTables], DataFrame]
    body: str | None
    views: tuple[str, ...]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.plan(StarTables(spark, sf_dir))
        return df.select(*[F.col(name).cast(_SPARK_TYPES[kind]).alias(name) for name, kind in self.columns])

    def sql(self) -> str | None:
        if self.body is None:
            return None
        shown = ", ".join(f'CAST("{name}" AS {_SQL_TYPES[kind]}) AS "{name}"' for name, kind in self.columns)
        return with_views(self.views, f"SELECT {shown} FROM ({self.body}) q")


QUERIES: dict[str, Query] = {}


def columns_of(text: str) -> tuple[tuple[str, str], ...]:
    """``"a b:text c:double"``: names with their kinds, whole numbers unless stated."""
    pairs = (item.partition(":") for item in text.split())
    return tuple((name, kind or "long") for name, _, kind in pairs)


def register(
    name: str,
    columns: str,
    plan: Callable[[StarTables], DataFrame],
    sql: str | None = None,
    views: Sequence[str] = (),
) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = Query(columns_of(columns), plan, sql, tuple(views))
