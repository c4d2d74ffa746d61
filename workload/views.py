"""Inputs of the registered queries, derived from the given tables.

Every view keeps all rows and whole texts.  ``SQL`` holds the same definitions for
the comparison queries, as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.ordering import range_bucket
from textloom.session import spread

NL, BELL = "\n", "\a"
# ligatures, full-width letters, an ellipsis: not NFKC
COMPOSED = "ﬁne oﬀer ＡＢｃ… "


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").drop("n_chars")


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for work that is heavy per row: a table of too few splits is spread over the task slots."""
    return spread(documents(spark, sf_dir), "doc_id")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def dirty(text: Column, case: Column) -> Column:
    """One kind of defect per case number; other numbers leave the text alone."""
    lit = F.lit

    def swap(t: Column, old: str, new: str) -> Column:
        return F.replace(t, lit(old), lit(new))

    defects = [
        F.concat(lit("<|user|> "), text, lit(" [INST]<EndOfText>")),
        F.concat(lit("See HTTP://example.com/x?y=1 "), swap(text, ". ", ". (www.example.org/z) ")),
        swap(text, ". ", ". mail <admin@example.com> or @b c@ d@@e "),
        swap(text, "e ", f"e{BELL} "),
        F.concat(lit(COMPOSED), swap(text, ". ", " [12]. {tpl x} [1234567] ")),
        swap(text, ". ", "!!!!!!!! "),
        F.concat(swap(text, ". ", " ( ) « ». "), lit(' "" [] x')),
        swap(swap(text, ", ", ' " " ( '), ". ", " » "),
        swap(text, ", ", f" {NL},"),
        F.concat(lit(f" {NL}\t"), swap(swap(text, ". ", ".  \t"), NL, NL * 3), lit(f"{NL} ")),
        F.translate(text, "abcdefghijklmnopqrstuvwxyz", "#$%&*+=~^|#$%&*+=~^|#$%&*+"),
        F.concat(lit("-def class import from return lambda {tpl}; "), text),
    ]
    out = text
    for number, defect in enumerate(defects):
        out = F.when(case == number, defect).otherwise(out)
    return out


def dirty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread_documents(spark, sf_dir)
    return _stored(docs, dirty(F.col("text"), F.col("doc_id") % 12))


def dirty_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spread(conversations(spark, sf_dir), "conv_id")
    case = (F.col("conv_id") * 3 + F.col("turn")) % 40
    return _stored(turns, F.when(case == 12, F.lit("")).otherwise(dirty(F.col("text"), case)))


def _stored(df: DataFrame, text: Column) -> DataFrame:
    """Replace the text as if it had been stored so; otherwise each mention would derive it again."""
    rest = [c for c in df.columns if c != "text"]
    return df.select(*rest, F.explode(F.array(text)).alias("text")).select(*df.columns)


def raw_dialogues(turns: DataFrame) -> DataFrame:
    """One row per conversation with messages in order, plus fields no schema asks for.

    A dialogue is one record of the data model, so it has to fit into a row.
    """
    messages = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    grouped = turns.groupBy(F.col("conv_id").alias("doc_id")).agg(messages.alias("messages"))
    return grouped.withColumn("type", F.lit("dialogue")).withColumn("lang", F.lit("en"))


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents, with their range of documents; the book id comes back after other books."""
    docs = spread(range_bucket(documents(spark, sf_dir), "doc_id", "_bucket"), "doc_id")
    return docs.select(
        "_bucket",
        "doc_id",
        (F.floor(F.col("doc_id") / 3) % 5).alias("book"),
        F.posexplode(F.split("text", NL, -1)).alias("line_no", "line"),
    )


def doc_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line as description, the others as nested parts."""
    lines = F.split("text", NL, -1)
    rest = F.slice(lines, F.lit(2), F.size(lines))
    return documents(spark, sf_dir).select(
        "doc_id",
        "lang",
        F.element_at(lines, 1).alias("description"),
        F.transform(rest, lambda t: F.struct(t.alias("clean_text"))).alias("parts"),
    )


def marked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A heading inserted after one of the first lines; it is a stop marker in some languages only."""
    headings = F.array(*map(F.lit, ("See also", "  Siehe auch: x", "Referencias", "Voir aussi", "x See also")))
    lines, after = F.split("text", NL, -1), (F.col("doc_id") % 4 + 1).cast("int")
    heading = F.get(headings, (F.col("doc_id") % 5).cast("int"))
    marked = F.concat(
        F.slice(lines, F.lit(1), after), F.array(heading), F.slice(lines, after + 1, F.size(lines))
    )
    return documents(spark, sf_dir).withColumn("text", F.array_join(marked, NL))


def source_number(source: Column) -> Column:
    return F.regexp_extract(source, r"(\d+)", 1).cast("int")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources of the documents, with a tier and a content type."""
    number = source_number(F.col("source"))
    names = documents(spark, sf_dir).select("source").distinct()
    return names.select(
        "source",
        (number % 3 + 1).alias("tier"),
        F.when(number % 10 == 9, "dialogue").otherwise("text").alias("content_type"),
    )


RULES = [
    ("src1", True, None),
    ("src2", False, 0.3),
    ("src3", None, 0.05),
    ("src5", False, 0.8),
    ("src6", True, 0.1),
    ("src8", False, 0.0),
    ("src11", None, None),
    ("src12", False, 0.02),
]
TIER_OVERRIDES = {"src1": 2, "src4": 7, "src9": 1, "src99": 2}
CHUNK_SIZES = (64, 128, 512)
CAPS = {"en": 400, "de": 50, "fr": 1, "it": 50}
SEED = 42

SQL = {
    "dirty": r"""
dirty AS (
  SELECT doc_id, lang, source, CASE doc_id % 12
    WHEN 0 THEN '<|user|> ' || text || ' [INST]<EndOfText>'
    WHEN 1 THEN 'See HTTP://example.com/x?y=1 ' || replace(text, '. ', '. (www.example.org/z) ')
    WHEN 2 THEN replace(text, '. ', '. mail <admin@example.com> or @b c@ d@@e ')
    WHEN 3 THEN replace(text, 'e ', 'e' || chr(7) || ' ')
    WHEN 4 THEN 'ﬁne oﬀer ＡＢｃ… ' || replace(text, '. ', ' [12]. {tpl x} [1234567] ')
    WHEN 5 THEN replace(text, '. ', '!!!!!!!! ')
    WHEN 6 THEN replace(text, '. ', ' ( ) « ». ') || ' "" [] x'
    WHEN 7 THEN replace(replace(text, ', ', ' " " ( '), '. ', ' » ')
    WHEN 8 THEN replace(text, ', ', ' ' || chr(10) || ',')
    WHEN 9 THEN ' ' || chr(10) || chr(9) || replace(replace(text, '. ', '.  ' || chr(9)),
                chr(10), chr(10) || chr(10) || chr(10)) || chr(10) || ' '
    WHEN 10 THEN translate(text, 'abcdefghijklmnopqrstuvwxyz', '#$%&*+=~^|#$%&*+=~^|#$%&*+')
    WHEN 11 THEN '-def class import from return lambda {tpl}; ' || text
  END AS text FROM documents)""",
    "turns": r"""
turns AS (
  SELECT conv_id, turn, role, CASE (conv_id * 3 + turn) % 40
    WHEN 0 THEN '<|user|> ' || text || ' [INST]<EndOfText>'
    WHEN 1 THEN 'See HTTP://example.com/x?y=1 ' || replace(text, '. ', '. (www.example.org/z) ')
    WHEN 2 THEN replace(text, '. ', '. mail <admin@example.com> or @b c@ d@@e ')
    WHEN 3 THEN replace(text, 'e ', 'e' || chr(7) || ' ')
    WHEN 4 THEN 'ﬁne oﬀer ＡＢｃ… ' || replace(text, '. ', ' [12]. {tpl x} [1234567] ')
    WHEN 5 THEN replace(text, '. ', '!!!!!!!! ')
    WHEN 6 THEN replace(text, '. ', ' ( ) « ». ') || ' "" [] x'
    WHEN 7 THEN replace(replace(text, ', ', ' " " ( '), '. ', ' » ')
    WHEN 8 THEN replace(text, ', ', ' ' || chr(10) || ',')
    WHEN 9 THEN ' ' || chr(10) || chr(9) || replace(replace(text, '. ', '.  ' || chr(9)),
                chr(10), chr(10) || chr(10) || chr(10)) || chr(10) || ' '
    WHEN 10 THEN translate(text, 'abcdefghijklmnopqrstuvwxyz', '#$%&*+=~^|#$%&*+=~^|#$%&*+')
    WHEN 11 THEN '-def class import from return lambda {tpl}; ' || text
    WHEN 12 THEN ''
    ELSE text
  END AS text FROM conversations)""",
    "doc_lines": r"""
doc_lines AS (
  SELECT doc_id, (doc_id // 3) % 5 AS book, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))""",
    "marked": r"""
marked AS (
  SELECT doc_id, lang, source, array_to_string(
    ls[1 : n] || [['See also', '  Siehe auch: x', 'Referencias', 'Voir aussi', 'x See also'][doc_id % 5 + 1]]
    || ls[n + 1 :], chr(10)) AS text
  FROM (SELECT *, string_split(text, chr(10)) AS ls, doc_id % 4 + 1 AS n FROM documents))""",
    "sources": r"""
sources AS (
  SELECT source, n % 3 + 1 AS tier, CASE WHEN n % 10 = 9 THEN 'dialogue' ELSE 'text' END AS content_type
  FROM (SELECT DISTINCT source, CAST(regexp_extract(source, '(\d+)', 1) AS INTEGER) AS n FROM documents))""",
    "rules": """
rules AS (
  SELECT * FROM (VALUES
    ('src1', TRUE, NULL), ('src2', FALSE, 0.3::DOUBLE), ('src3', NULL, 0.05::DOUBLE),
    ('src5', FALSE, 0.8::DOUBLE), ('src6', TRUE, 0.1::DOUBLE), ('src8', FALSE, 0.0::DOUBLE),
    ('src11', NULL, NULL), ('src12', FALSE, 0.02::DOUBLE)
  ) t(source, use_all, proportion))""",
}
