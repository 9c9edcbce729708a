"""Readers for landed CSV tables and JSON payloads, and the completeness report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstack.functions.scalars import FILE_NULL_TEXT
from lapstack.operators.groups import union_all
from lapstack.schemas import BRONZE_COLUMNS, payload_schema
from lapstack.session import stage

# Texts read as missing when a file follows the wider convention.
WIDE_NULL_TEXTS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_text_csv(
    spark: SparkSession, path: str, columns: Sequence[str], wide_nulls: bool = False, multi_line: bool = False
) -> DataFrame:
    """All-text scan, columns taken by header name; a byte-order mark and bad bytes are tolerated.

    Columns the file lacks are NULL, others it has are left out. Quoted line breaks need
    ``multi_line``, which gives up splitting a file over tasks.
    """
    found = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("nullValue", FILE_NULL_TEXT)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    present = set(found.columns)
    text = {c: F.col(f"`{c}`") if c in present else F.lit(None).cast("string") for c in columns}
    if wide_nulls:
        text = {c: F.when(~v.isin(*WIDE_NULL_TEXTS), v) for c, v in text.items()}
    return found.select(*[v.alias(c) for c, v in text.items()])


def read_history(spark: SparkSession, raw_dir: str, wide_nulls: bool = False) -> dict[str, DataFrame]:
    """The historical tables, tagged with their lineage."""
    return {
        table: read_text_csv(spark, f"{raw_dir}/{table}.csv", columns, wide_nulls).withColumn("source", F.lit("historical"))
        for table, columns in BRONZE_COLUMNS.items()
    }


def in_file_order(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of a CSV file with ``_place``, that of the row in the file; stored, so that it stays.

    Blocks of a file are read in any order; inside a block rows are numbered as they are read.
    """
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    found = spark.read.option("header", True).option("nullValue", FILE_NULL_TEXT).option("escape", '"').csv(path)
    return stage(found.select(*[F.col(f"`{c}`") for c in columns], order.alias("_place")), "in-file-order")


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file; contents are not read."""
    return spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0


def read_payload(spark: SparkSession, path: str, endpoint: str, multi_line: bool = True) -> DataFrame:
    """One nested row per payload document: a file each, or (splittable) a line each.

    A document that is too large for a task is read by ``documents.split_items`` or ``split_entries``.
    """
    return spark.read.schema(payload_schema(endpoint)).option("multiLine", multi_line).json(path)


def year_of(path: Column) -> Column:
    """The number that names the folder (``2025`` or ``year=2025``) of a file, NULL where it is no number."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)  # for every row of a file: no search by expression
    folder = F.when(folder.startswith("year="), F.substring(folder, 6, 1 << 30)).otherwise(folder)
    return F.when(folder.rlike("^[0-9]+$"), folder.cast("int"))


def year_from_path(df: DataFrame) -> DataFrame:
    """Add ``year``, that of a row's file."""
    return df.select("*", year_of(F.col("_metadata.file_path")).alias("year"))


def select_years(df: DataFrame, start_year: int) -> DataFrame:
    """Rows of numeric year folders from ``start_year`` on; other folders are left out."""
    return year_from_path(df).filter(F.col("year") >= start_year)


# where year documents lie: a folder for each year, or for each endpoint
BY_YEAR, BY_ENDPOINT = "{root}/*/{endpoint}.json", "{root}/{endpoint}/*"


def read_year_payloads(
    spark: SparkSession, root: str, endpoint: str, start_year: int, layout: str = BY_YEAR
) -> DataFrame:
    """An endpoint's payloads of all wanted years, with their ``year``."""
    return select_years(read_payload(spark, layout.format(root=root, endpoint=endpoint), endpoint), start_year)


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """``path``, ``bytes`` and ``changed`` of every file below a folder; folders are listed by Spark, contents not read.

    Spark gives empty files to no task: they are known from its listing alone, with no time.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    listed = spark.createDataFrame([(p,) for p in found.inputFiles()], "path string").select(_plain_path("path").alias("path"))
    sizes = found.select(_plain_path("path").alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))
    return listed.join(sizes, "path", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0)))


def _plain_path(column: str) -> Column:
    """A local path is written with one slash or three."""
    return F.regexp_replace(column, "^file:/+", "file:/")


def inventory_report(expected: DataFrame, files: DataFrame, pattern: str) -> DataFrame:
    """One row per expected file or folder: its files, their bytes and the newest time; passed if none is missing or empty.

    ``pattern`` takes the texts of the columns of ``expected`` out of a path, a group for each in their order; paths
    that do not match belong to nothing that is expected.
    """
    names = expected.columns
    parts = [F.regexp_extract("path", pattern, i + 1).alias(n) for i, n in enumerate(names)]
    found = files.filter(F.col("path").rlike(pattern)).select(*parts, "bytes", "changed").groupBy(*names).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.min("bytes").alias("least"), F.max("changed").alias("changed")
    )
    wanted = expected.select(*[F.col(n).cast("string").alias(n) for n in names])
    return wanted.join(found, names, "left").select(
        *names,
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
        "changed",
        (F.coalesce("least", F.lit(0)) > 0).alias("passed"),
    )


def completeness_report(
    expected: DataFrame, present: Mapping[str, DataFrame], last_year: DataFrame | None = None, expected_year: int = 0
) -> DataFrame:
    """One row per expected ``name``: found, non-empty, and recent enough.

    ``last_year`` is a one-column frame of years; its maximum must reach ``expected_year``.
    """
    schema = "name string, row_count bigint"
    spark = expected.sparkSession
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), "row_count")
        for name, df in present.items()
    ]
    actual = union_all(counts) if counts else spark.createDataFrame([], schema)
    report = expected.join(actual, "name", "left").select(
        F.lit("table").alias("check"),
        "name",
        F.coalesce("row_count", F.lit(0)).alias("found"),
        (F.coalesce("row_count", F.lit(0)) > 0).alias("passed"),
    )
    if last_year is None:
        return report
    recent = last_year.agg(F.max(F.col(last_year.columns[0]).cast("bigint")).alias("found")).select(
        F.lit("last_year").alias("check"),
        F.lit("year").alias("name"),
        F.coalesce("found", F.lit(0)).alias("found"),
        F.coalesce(F.col("found") >= expected_year, F.lit(False)).alias("passed"),
    )
    return report.unionByName(recent)


def missing_names(expected: DataFrame, actual: DataFrame) -> DataFrame:
    return expected.join(actual, "name", "left_anti")
