"""Writers: bronze files, warehouse tables, load validation, CSV bundle."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstack.functions.scalars import FILE_NULL_TEXT
from lapstack.operators.groups import union_all
from lapstack.operators.scans import dense_ids
from lapstack.schemas import BRONZE_COLUMNS

FILE_ROWS = 1_000_000  # of a bronze file

# Load modes of the warehouse and the writer modes they stand for.
LOAD_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def bronze_layout(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed column order plus ``source``; extra columns go, missing ones are NULL."""
    present = set(df.columns)
    wanted = [*columns, "source"]
    return df.select(
        *[(F.col(f"`{c}`") if c in present else F.lit(None)).cast("string").alias(c) for c in wanted]
    )


def write_bronze(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[Column] = ()) -> None:
    """CSV with a header and the text ``NULL`` for missing values, in a fixed row order."""
    laid_out = bronze_layout(df, columns)
    if order:
        laid_out = laid_out.orderBy(*order)
    write_csv(laid_out, path)


def write_fixed(
    df: DataFrame, path: str, columns: Sequence[str], order: Sequence[Column], file_rows: int = FILE_ROWS
) -> None:
    """As ``write_bronze``, with the same files byte for byte on every cluster.

    Rows are numbered in the (total) order and dealt to files by their number, ``file_rows`` to a file; files are named
    by their place. An empty table is one file with the header.
    """
    spark = df.sparkSession
    numbered = dense_ids(bronze_layout(df, columns), order, "_n")
    # told from rows that are stored with their places: no need to store them with their numbers too
    numbered = numbered.withColumn("_file", F.floor((F.col("_n") - 1) / file_rows).cast("int"))
    files = (numbered.agg(F.max("_file")).first()[0] or 0) + 1
    write_csv(numbered.repartitionById(files, F.col("_file")).sortWithinPartitions("_n").drop("_n", "_file"), path)
    store = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = store.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in names.listStatus(store):  # a name for each file
        number = re.match(r"part-(\d+)-", found.getPath().getName())
        if number:
            names.rename(found.getPath(), spark._jvm.org.apache.hadoop.fs.Path(store, f"part-{number.group(1)}.csv"))


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", FILE_NULL_TEXT)
        .option("emptyValue", "")
        .option("escape", '"')
        .csv(path)
    )


def create_layers(spark: SparkSession, layers: Sequence[str], location: str | None = None) -> None:
    for layer in layers:
        place = f" LOCATION '{location}/{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`{place}")


def write_table(df: DataFrame, table: str, mode: str = "replace", partition: str | None = None) -> None:
    """Save as a Parquet table; files of a partition come from every task, so no row moves only to be written."""
    writer = df.write.format("parquet").option("compression", "zstd").mode(LOAD_MODES[mode])
    if partition:
        writer = writer.partitionBy(partition)
    writer.saveAsTable(table)


def load_table(
    spark: SparkSession, path: str, table: str, columns: Sequence[str], mode: str = "replace", wide_nulls: bool = False
) -> None:
    """Load one bronze CSV as an all-text table; a failure is raised, never only logged.

    ``wide_nulls`` takes the texts of the wider convention (``NA``, ``None``, ``nan``, ...) as missing too.
    """
    from lapstack.sources.files import read_text_csv

    write_table(read_text_csv(spark, path, [*columns, "source"], wide_nulls), table, mode)


def load_warehouse(
    spark: SparkSession, bronze_dir: str, database: str = "bronze", mode: str = "replace", wide_nulls: bool = False
) -> None:
    for table, columns in BRONZE_COLUMNS.items():
        load_table(spark, f"{bronze_dir}/{table}", f"{database}.{table}", columns, mode, wide_nulls)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named frame, as one frame."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return union_all(parts)


def validate_load(spark: SparkSession, database: str = "bronze", expected: Sequence[str] = tuple(BRONZE_COLUMNS)) -> DataFrame:
    """Row counts of the expected tables; a missing table is an error."""
    missing = [t for t in expected if not spark.catalog.tableExists(f"{database}.{t}")]
    if missing:
        raise ValueError(f"tables missing in {database}: {', '.join(missing)}")
    return table_counts({t: spark.table(f"{database}.{t}") for t in expected})


def export_bundle(tables: Mapping[str, DataFrame], root: str) -> list[str]:
    """Each table as one CSV folder under ``root``."""
    paths = []
    for name, df in tables.items():
        write_csv(df, f"{root}/{name}")
        paths.append(f"{root}/{name}")
    return paths
