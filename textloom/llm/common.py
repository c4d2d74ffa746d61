"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import scratch_path

BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the wanted columns, as ``out="type of name"`` or ``out=("name", "type")``.

    Columns are found by their exact name first and by position after that, so extra
    columns whose names clash (also in upper case, or with names used inside an
    operator) do no harm.  A missing column is a column of nulls.
    """
    places = [f"_{i}" for i in range(len(df.columns))]
    renamed = df.toDF(*places)
    picked: list[Column] = []
    for out, want in columns.items():
        name, kind = want if isinstance(want, tuple) else (out, want)
        exact = [i for i, c in enumerate(df.columns) if c == name]
        loose = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
        found = (exact or loose)[:1]
        value = F.col(places[found[0]]) if found else F.lit(None)
        picked.append((value.cast(kind) if kind else value).alias(out))
    return renamed.select(*picked)


def by_place(df: DataFrame) -> tuple[DataFrame, Callable[[str], str | None]]:
    """``df`` with columns named by their place, and the new name of a column (exact name first, then any case).

    ``toDF(*df.columns)`` gives the old names back, whatever they are.
    """
    names = [f"c{i}" for i in range(len(df.columns))]

    def name_of(name: str) -> str | None:
        same = [n for n, c in zip(names, df.columns, strict=True) if c == name]
        like = [n for n, c in zip(names, df.columns, strict=True) if c.lower() == name.lower()]
        return (same or like or [None])[0]

    return df.toDF(*names), name_of


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe if executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_place(df: DataFrame) -> DataFrame:
    """``df`` with ``place_file`` and ``place_row``, which rise in the order of its rows.

    For a scan of Parquet files that is the order they were written in: part number and row in the file, whatever
    the split of the scan.  Any other table has the order of its partitions.
    """
    if _is_scan(df):
        try:
            stored_at = df.metadataColumn("_metadata")
            path = stored_at["file_path"]
            name = F.substring_index(path, "/", -1)
            number = F.lpad(F.regexp_extract(name, "^part-([0-9]+)", 1), 10, "0")
            folder = F.substring(path, F.lit(1), F.length(path) - F.length(name))
            file = F.concat(folder, number, F.lit(" "), name)
            return df.select("*", file.alias("place_file"), stored_at["row_index"].alias("place_row"))
        except AnalysisException:  # files without row numbers
            pass
    place = F.monotonically_increasing_id()  # partition and row in it
    file = F.lpad(F.shiftright(place, 33).cast("string"), 10, "0")
    return df.select("*", file.alias("place_file"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("place_row"))


def _is_scan(df: DataFrame) -> bool:
    """Whether ``df`` reads files and at most filters rows and picks columns, so that places in the files tell its order."""
    node = df._jdf.queryExecution().analyzed()
    while node.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.child()
    return node.getClass().getSimpleName() == "LogicalRelation"


def blocks(batches: Iterator[pa.RecordBatch], column: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches whose ``column`` holds about ``size`` bytes (one row at least)."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start, total = 0, 0
        for i, n in enumerate(lengths):
            if i > start and total + n > size:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(lengths):
            yield batch.slice(start)


def held_out(doc_id: Column) -> Column:
    """The rows whose labels no model may see: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
