"""Parquet scans and sinks.

A missing table reads as empty where that is asked for and raises elsewhere; an empty table is written like any other.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Scan a Parquet table; a missing path raises."""
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet path can be read at all (an empty table exists, too)."""
    try:
        spark.read.schema(T.StructType([])).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan with a declared schema; a missing path gives zero rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length) of the data files below ``path``, from the listing alone; a missing path has none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    try:
        return files.load(path).select("path", "length")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "path string, length long")
        raise


def file_counts(spark: SparkSession, paths: list[str]) -> tuple[int, list[str]]:
    """Rows of all readable Parquet files below ``paths``, and the names of the unreadable ones.

    One job counts by file from the footers.  A file it does not name is empty or unreadable and is opened once more by itself;
    the driver holds the names of those only.
    """
    rows, bad = 0, []
    for path in paths:
        if not path_exists(spark, path):
            continue
        readable = spark.read.option("ignoreCorruptFiles", "true").schema(T.StructType([])).parquet(path)
        counted = readable.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
        plain = lambda file: F.regexp_replace(file, "^file:/+", "file:/")
        there = list_files(spark, path, "*.parquet").select(plain(F.col("path")).alias("name"), F.col("path").alias("at"))
        joined = there.join(counted.select(plain(F.col("file")).alias("name"), "n"), "name", "left")
        rows += joined.agg(F.sum("n")).first()[0] or 0
        for row in joined.where("n is null").select("at").collect():
            try:
                spark.read.parquet(row["at"]).count()
            except Exception:  # whatever a broken file makes Spark raise
                bad.append(row["at"])
    return rows, sorted(bad)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote; a missing one is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def count_rows(spark: SparkSession, path: str) -> int:
    """Row count from the file footers; missing and unreadable files count as zero (``file_counts`` names them)."""
    if not path_exists(spark, path):
        return 0
    files = spark.read.option("ignoreCorruptFiles", "true").schema(T.StructType([]))
    return files.parquet(path).count()


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> int:
    """Write zstd Parquet and return the row count, taken while writing.

    A table without rows is written, too, so that later stages find it.
    """
    rows = Observation("rows")
    observed = df.observe(rows, F.count(F.lit(1)).alias("n"))
    observed.write.mode(mode).option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return rows.get["n"]


def write_json(df: DataFrame, path: str, *order: Column) -> None:
    """Write a small report as a single JSON-lines file, in the given order."""
    rows = df.coalesce(1)
    (rows.sortWithinPartitions(*order) if order else rows).write.mode("overwrite").json(path)
