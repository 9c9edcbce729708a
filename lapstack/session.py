"""Session settings, the shared work folder, and the sizes that pick a physical plan."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP_ROWS = "spark.lapstack.groupRows"
DOCUMENT_BYTES = "spark.lapstack.documentBytes"
_TUNED = "spark.lapstack.tuned"

_DEFAULT_GROUP_ROWS = 2_000_000
_DEFAULT_DOCUMENT_BYTES = 64 << 20
_FEW_ROWS = 100_000

_SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join side is split even where the next step needs its partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # shuffles start with many partitions, which are joined again where the rows are few: sorts stay in memory at any size
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # files are read in pieces whose rows, many times larger unpacked, a task sorts for a shuffle without spilling
    "spark.sql.files.maxPartitionBytes": "32m",
    # sorted keys and names made from them take a thirtieth of their memory in a file: by the size of its files alone, a
    # table of millions of rows would be broadcast, which the driver has to hold
    "spark.sql.sources.fileCompressionFactor": "32",
    # a task writes a file for each year it meets, without sorting its rows by year first
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # year partitions are replaced one by one, never the whole table
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings the plans rely on, once per session; what a caller sets afterwards stays."""
    if spark.conf.get(_TUNED, None) is None:
        for key, value in _SQL_SETTINGS.items():
            if spark.conf.get(key, None) != value:
                spark.conf.set(key, value)
        spark.conf.set(_TUNED, "true")
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g", **extra) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lapstack")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a temporary folder of its own, which goes when Python ends.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        own = tempfile.mkdtemp(prefix="lapstack-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
        current = context.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder, in that of the application, that no other run uses."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete what this application has staged; for its end, when no frame over staged rows is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Compute a small frame once, into the shared folder, for several readers and for Spark's size checks."""
    return stage(df, "settled")


def few(df: DataFrame) -> DataFrame:
    """A stored frame for a join with many rows: broadcast where it is counted to have few rows, else left to Spark."""
    return F.broadcast(df) if df.count() <= _FEW_ROWS else df


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it back, column by column."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_rows(spark: SparkSession) -> int:
    """Rows one task may sort as a single window group."""
    return int(spark.conf.get(GROUP_ROWS, str(_DEFAULT_GROUP_ROWS)))



def document_bytes(spark: SparkSession) -> int:
    """Bytes of a nested document that one task may read whole."""
    return int(spark.conf.get(DOCUMENT_BYTES, str(_DEFAULT_DOCUMENT_BYTES)))
