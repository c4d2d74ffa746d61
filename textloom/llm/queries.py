"""One query per operator of this package, over its whole table; SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import arrow_output, cotraining, cross_polytope, fp_tree, gnat, impact_index, mixing_pfair, ngram_jaccard, packing, recompression, reply_trees, toxicity, url_templates
from textloom.llm.common import pick, stored, table


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))


def op1_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(vectors(spark, sf_dir), F.col("vec_id") % 20 == 0, k=20)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)


# target weights: one to four parts, from the number in a source's name
def source_weight() -> Column:
    return F.coalesce(F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4 + 1"), F.lit(1))


SOURCE_WEIGHT_SQL = "coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 4 + 1, 1)"


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing_pfair.mix(docs, mixing_pfair.weights_by_rule(docs, source_weight()))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), end_id=0, size=2048)


def op6_arrow_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_output.read_documents(arrow_output.write_shards(table(spark, sf_dir, "documents"), end_id=1))


def op7_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotraining.score_documents(docs, cotraining.learn(docs, table(spark, sf_dir, "labels")))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    formatted = reply_trees.format_trees(reply_trees.conversations_as_trees(turns))
    return reply_trees.digests(reply_trees.read_formatted(stored(formatted, "chat")))


def op9_impact_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_index.top_k(vectors(spark, sf_dir), F.col("vec_id") % 20 == 0, k=20, scale=64)


URL_RULES = (
    url_templates.Rule("net", "/", "block"),
    url_templates.Rule("example.net", "/en/", "allow"),
    url_templates.Rule("example.com", "/de/", "block"),
    url_templates.Rule("org", "/fr/", "allow"),
)


def op10_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are labelled by the document whose number ends their path: bad if of low quality or toxic."""
    labels = pick(table(spark, sf_dir, "labels"), doc_id="long", quality="int", toxic="int")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull(), 0)
    bad_pages = labels.select(F.col("doc_id").alias("key"), bad.alias("bad"))
    return url_templates.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, bad_pages)


def op11_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(table(spark, sf_dir, "documents"), window=50, with_text=False)


RELABELLED = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


def op12_gnat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.expr(RELABELLED).alias("label"), F.col("embedding").alias("vector"))
    return gnat.hard_negatives(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=10)


def op13_fp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_tree.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


PAGE_LABELS_SQL = """SELECT doc_id AS key,
  CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL THEN 0 END AS bad FROM labels"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cross_polytope": op1_cross_polytope,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_mixing": op4_mixing,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_arrow_output": op6_arrow_output,
    "op7_cotraining": op7_cotraining,
    "op8_chat_format": op8_chat_format,
    "op9_impact_index": op9_impact_index,
    "op10_url_templates": op10_url_templates,
    "op11_recompression": op11_recompression,
    "op12_gnat": op12_gnat,
    "op13_fp_tree": op13_fp_tree,
}

ORACLES: dict[str, str] = {
    "op3_ngram_jaccard": ngram_jaccard.oracle(3, 90),
    "op4_mixing": mixing_pfair.oracle(SOURCE_WEIGHT_SQL),
    "op8_chat_format": reply_trees.ORACLE,
    "op9_impact_index": impact_index.oracle("embeddings", "embedding", "{} % 20 = 0"),
    "op10_url_templates": url_templates.oracle(URL_RULES, PAGE_LABELS_SQL),
    "op11_recompression": recompression.ORACLE,
    "op12_gnat": gnat.oracle(RELABELLED, "{} % 100 = 0"),
    "op13_fp_tree": fp_tree.ORACLE,
}
