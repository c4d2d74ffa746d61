"""Fixed record schemas; sources are projected onto them, never inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)

# (doc_id, part) is the record key: Spark rows carry no order of their own.
TEXT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("lang", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

DIALOGUE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("lang", T.StringType()),
        T.StructField("messages", T.ArrayType(MESSAGE)),
    ]
)

CHUNK = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("char_count", T.LongType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("num_records", T.LongType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("languages", T.ArrayType(T.StringType())),
        # a part of a source that is worked on by itself; null: the whole source
        T.StructField("subset", T.StringType()),
        # folder of the result that this entry publishes
        T.StructField("version", T.StringType()),
        T.StructField("bad_files", T.ArrayType(T.StringType())),
        T.StructField("bad_lines", T.LongType()),
        T.StructField("failed_subsets", T.ArrayType(T.StringType())),
    ]
)

SOURCE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("tier", T.IntegerType()),
        T.StructField("content_type", T.StringType()),
    ]
)

RULE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("use_all", T.BooleanType()),
        T.StructField("proportion", T.DoubleType()),
    ]
)

BY_CONTENT = {"text": TEXT, "dialogue": DIALOGUE}


def project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: extra columns go, missing ones become null, types are cast.

    Struct fields are matched by position in a Spark cast, so arrays of structs
    with extra fields are rebuilt by name.
    """
    have = {f.name: f.dataType for f in df.schema}
    columns = []
    for field in schema:
        if field.name not in have:
            column = F.lit(None)
        elif _is_struct_array(field.dataType) and _is_struct_array(have[field.name]):
            names = set(have[field.name].elementType.names)
            column = F.transform(
                F.col(field.name), _named_fields(field.dataType.elementType.names, names)
            )
        else:
            column = F.col(field.name)
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def _is_struct_array(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)


def _named_fields(wanted: list[str], have: set[str]):
    return lambda m: F.struct(*[(m[n] if n in have else F.lit(None)).alias(n) for n in wanted])
