"""Declarative data checks; each gives rows ``(check, table_name, column_name, violations, passed)``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lapstack.operators.bitmaps import Link, lost_keys, rows_with_lost_keys
from lapstack.operators.groups import union_all
from lapstack.schemas import (
    BRONZE_COLUMNS,
    BRONZE_FOREIGN_KEYS,
    ID_COLUMNS,
    NOT_NULL_COLUMNS,
    RELATIONSHIPS,
    SOURCE_VALUES,
    UNIQUE_COLUMNS,
)
from lapstack.session import few, settle

REPORT = "check string, table_name string, column_name string, violations bigint, passed boolean"


def _report(counts: DataFrame, check: str, table: str, column: str, violations: str = "violations") -> DataFrame:
    found = F.coalesce(F.col(violations), F.lit(0)).cast("bigint")
    return counts.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        found.alias("violations"),
        (found == 0).alias("passed"),
    )


def tables_exist(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """One row per expected table; a missing one is a violation."""
    rows = [(t, 0 if spark.catalog.tableExists(t) else 1) for t in tables]
    frame = spark.createDataFrame(rows, "table_name string, violations bigint")
    return frame.select(
        F.lit("table_exists").alias("check"),
        "table_name",
        F.lit("").alias("column_name"),
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def row_count(df: DataFrame, table: str, minimum: int = 0) -> DataFrame:
    """Rows short of the minimum."""
    short = df.agg(F.greatest(F.lit(minimum) - F.count(F.lit(1)), F.lit(0)).alias("violations"))
    return _report(short, "row_count", table, "")


def primary_key(df: DataFrame, table: str, key: str) -> DataFrame:
    """NULL keys plus keys used more than once, from one grouping of the key."""
    k = F.col(f"`{key}`")
    sizes = df.groupBy(k.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    issues = sizes.agg(
        (
            F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0)) + F.count_if(F.col("_n") > 1)
        ).alias("violations")
    )
    return _report(issues, "primary_key", table, key)


def foreign_key(df: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-NULL key the parent lacks: keys are counted before the anti join."""
    used = df.select(F.col(f"`{column}`").alias("_k")).filter("_k IS NOT NULL").groupBy("_k").agg(
        F.count(F.lit(1)).alias("_n")
    )
    orphans = used.join(parent.select(F.col(f"`{parent_key}`").alias("_k")).distinct(), "_k", "left_anti")
    return _report(orphans.agg(F.sum("_n").alias("violations")), "foreign_key", table, column)


def foreign_keys(tables: Mapping[str, DataFrame], links: Sequence[Link]) -> DataFrame:
    """Rows of every foreign key whose parent is missing, all keys of all tables from one pass over each."""
    lost = lost_keys(tables, links).groupBy("child", "column").agg(F.sum("n").alias("n"))
    spark = next(iter(tables.values())).sparkSession
    named = spark.createDataFrame([(x.child, x.column) for x in links], "child string, column string")
    return named.join(lost, ["child", "column"], "left").select(
        F.lit("foreign_key").alias("check"),
        F.col("child").alias("table_name"),
        F.col("column").alias("column_name"),
        F.coalesce("n", F.lit(0)).alias("violations"),
        F.col("n").isNull().alias("passed"),
    )


def source_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("row_count"))


def accepted_source(df: DataFrame, table: str, null_allowed: bool = True) -> DataFrame:
    """Rows whose lineage is not one of the known values; NULL passes only where allowed."""
    known = F.col("source").isin(*SOURCE_VALUES)
    bad = F.col("source").isNotNull() & ~known if null_allowed else F.col("source").isNull() | ~known
    counts = source_counts(df).agg(F.sum(F.when(bad, F.col("row_count"))).alias("violations"))
    return _report(counts, "accepted_source", table, "source")


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULL counts of all columns in one pass, then one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = counts.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns])).alias("r")
    )
    return rows.select(
        F.lit("not_null").alias("check"),
        F.lit(table).alias("table_name"),
        F.col("r.column_name").alias("column_name"),
        F.col("r.violations").cast("bigint").alias("violations"),
        (F.col("r.violations") == 0).alias("passed"),
    )


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Non-NULL values used more than once.

    Numbers told from the values are counted first. Only values that share their number, as every repeated one does, are
    counted themselves, so that long keys stay where they are.
    """
    values = df.select(F.col(f"`{column}`").alias("_k")).filter("_k IS NOT NULL")
    # 0.0 and -0.0 are one value, with one number
    plain = F.col("_k") + F.lit(0.0) if dict(values.dtypes)["_k"] in ("double", "float") else F.col("_k")
    values = values.withColumn("_h", F.xxhash64(plain))
    shared = values.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_h")
    repeated = values.join(few(settle(shared)), "_h", "left_semi").groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    return _report(repeated.agg(F.count_if(F.col("_n") > 1).alias("violations")), "unique", table, column)


def relationship(df: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return foreign_key(df, table, column, parent, parent_key).withColumn("check", F.lit("relationship"))


def declared_rules(
    tables: Mapping[str, DataFrame],
    uniques: Mapping[str, Sequence[str]] = UNIQUE_COLUMNS,
    not_nulls: Mapping[str, Sequence[str]] = NOT_NULL_COLUMNS,
    relationships: Sequence[tuple[str, str, str]] = RELATIONSHIPS,
) -> DataFrame:
    """All declared rules that apply to the given tables."""
    parts = [not_null(tables[t], t, columns) for t, columns in not_nulls.items() if t in tables]
    parts += [unique(tables[t], t, c) for t, columns in uniques.items() if t in tables for c in columns]
    for table, column, parent in relationships:
        if table in tables and parent in tables:
            parts.append(relationship(tables[table], table, column, tables[parent], column))
    return union_all(parts)


def written_and_checked(
    tables: Mapping[str, DataFrame],
    write: Callable[[str, DataFrame], DataFrame],
    uniques: Mapping[str, Sequence[str]] = UNIQUE_COLUMNS,
    not_nulls: Mapping[str, Sequence[str]] = NOT_NULL_COLUMNS,
    relationships: Sequence[tuple[str, str, str]] = RELATIONSHIPS,
    sources: Sequence[str] = (),
) -> DataFrame:
    """The report of all declared rules, and of row counts and known sources, for tables as they are written.

    ``write(name, rows)`` stores a table and gives it back to be read. NULLs, rows and sources are counted while the
    rows pass to the writer. Uniqueness and relationships are told from the key columns of the stored tables, each
    read alone. ``sources`` names the tables whose lineage is checked.
    """
    lines: list[tuple[str, str, str, int]] = []
    stored: dict[str, DataFrame] = {}
    for name, df in tables.items():
        seen = Observation()
        metrics = [F.count(F.lit(1)).alias("rows")]
        metrics += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_nulls.get(name, ())]
        if name in sources:
            metrics.append(F.count_if(F.col("source").isNotNull() & ~F.col("source").isin(*SOURCE_VALUES)).alias("bad_source"))
        stored[name] = write(name, df.observe(seen, *metrics))
        found = seen.get
        lines.append(("row_count", name, "", 0 if found["rows"] else 1))
        lines += [("not_null", name, c, found[f"null_{c}"]) for c in not_nulls.get(name, ())]
        if name in sources:
            lines.append(("accepted_source", name, "source", found["bad_source"]))
    spark = next(iter(tables.values())).sparkSession
    told = spark.createDataFrame([(*x, x[3] == 0) for x in lines], REPORT)
    return union_all([told, declared_rules(stored, uniques, {}, relationships)])


def violating(df: DataFrame, invariant: Column) -> DataFrame:
    """Rows for which the invariant is not true; unknown is not a violation."""
    return df.filter(~invariant)


def circuit_invariants() -> Column:
    """Totals and seasons of a circuit fit together."""
    broken = (
        (F.col("total_wins") < 0)
        | (F.col("total_podiums") < F.col("total_wins"))
        | (F.col("total_podiums") < 0)
        | (F.col("races_hosted") < F.col("seasons_hosted"))
        | (F.col("first_season") > F.col("last_season"))
        | (F.col("latest_season") < F.col("last_season"))
    )
    return ~broken


def hub_orphans(
    hub: DataFrame, drivers: DataFrame, constructors: DataFrame, circuits: DataFrame, races: DataFrame
) -> DataFrame:
    """Keys of hub rows that lack a driver, constructor, circuit or race."""
    parents = {"driver_id": drivers, "constructor_id": constructors, "circuit_id": circuits, "race_id": races}
    keyed = {key: (parent, key) for key, parent in parents.items()}
    return rows_with_lost_keys(hub.select("race_driver_key", *parents), keyed, null_is_lost=True).select("race_driver_key")


def size_and_lineage(df: DataFrame, table: str, minimum: int = 0) -> DataFrame:
    """The row-count and lineage checks of a table from one pass over it."""
    bad = F.col("source").isNotNull() & ~F.col("source").isin(*SOURCE_VALUES)
    found = df.agg(
        F.greatest(F.lit(minimum) - F.count(F.lit(1)), F.lit(0)).alias("short"), F.count_if(bad).alias("bad")
    )
    lines = F.array(
        F.struct(F.lit("row_count").alias("check"), F.lit("").alias("column_name"), F.col("short").alias("n")),
        F.struct(F.lit("accepted_source").alias("check"), F.lit("source").alias("column_name"), F.col("bad").alias("n")),
    )
    return found.select(F.explode(lines).alias("r")).select(
        F.col("r.check").alias("check"),
        F.lit(table).alias("table_name"),
        F.col("r.column_name").alias("column_name"),
        F.col("r.n").cast("bigint").alias("violations"),
        (F.col("r.n") == 0).alias("passed"),
    )


def bronze_report(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, str] = ID_COLUMNS,
    foreign_keys_of: Sequence[tuple[str, str, str]] = BRONZE_FOREIGN_KEYS,
    minimum: int = 0,
) -> DataFrame:
    """Row counts, primary keys, foreign keys and lineage of the bronze tables."""
    tables = dict(tables)
    parts = [
        size_and_lineage(df, t, minimum) if "source" in df.columns else row_count(df, t, minimum)
        for t, df in tables.items()
    ]
    parts += [primary_key(tables[t], t, k) for t, k in keys.items() if t in tables]
    links = [
        Link(t, c, tables[parent], keys[parent]) for t, c, parent in foreign_keys_of if t in tables and parent in tables
    ]
    if links:
        parts.append(foreign_keys({t: tables[t] for t in {x.child for x in links}}, links))
    return union_all(parts)


def report_passed(report: DataFrame) -> DataFrame:
    """One row: all checks passed. Lineage is reported but does not decide."""
    decisive = report.filter(F.col("check") != "accepted_source")
    return decisive.agg(F.coalesce(F.min("passed"), F.lit(True)).alias("passed"))


def check_warehouse(spark: SparkSession, database: str = "bronze") -> DataFrame:
    """Existence first, then the full report over the tables there are."""
    names = {t: f"{database}.{t}" for t in BRONZE_COLUMNS}
    there = {t: spark.table(n) for t, n in names.items() if spark.catalog.tableExists(n)}
    return union_all([tables_exist(spark, list(names.values())), bronze_report(there)])
