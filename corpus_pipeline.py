"""The training-data pipeline: language ID, quality rules, near duplicates, packing, each stage over all its documents.

Every stage decides row by row; ids are only carried. Defined results: a null or empty text, or one without letters, goes
with the language stage; rows with a null id are treated like others and stay null; of rows that share an id each is
decided by its own text; of exactly repeated rows one stays; very long texts are read whole; without labels only the base
rules reject; empty tables give empty tables; further columns, whatever their names, are left out by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lintlake.functions.scale import stage
from lintlake.llm import jaccard, language_id, packing, quality
from lintlake.llm.tables import stage_compressed
from lintlake.llm.tokens import vocabulary_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language: no text, no letters, or two languages too close to tell."""
    found = language_id.predict(docs.select(COLUMNS), language_id.train(docs))
    return found.filter((F.col("lang_pred") != language_id.UNKNOWN) & ~F.col("ambiguous")).select(COLUMNS)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows that the base rules or the risk-controlled cutoffs reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judge(docs.select(COLUMNS), labels, carry=COLUMNS).filter("kept").select("carried.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every group linked by five-word shingles at similarity 0.8: that with the smallest id.

    A row without id stays only where its group has none with one. Rows get numbers of their own for the join, written
    before they are used, so that a task that runs again finds the same ones.
    """
    rows = stage_compressed(docs.select(COLUMNS).withColumn("row", F.monotonically_increasing_id()), "numbered")
    groups = jaccard.join(rows.select(F.col("row").alias("doc_id"), "text"), width=5, percent=80)
    members = groups.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row"))
    kept = members.groupBy("component_id").agg(first.alias("first")).select("first.row")
    return rows.join(kept, "row", "left_semi").select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of 2048 tokens."""
    return packing.pack(docs, vocabulary_path()).drop("ids")


STAGES = [
    ("language ID", identify_language),
    ("quality rules", apply_quality_rules),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: Classifiers, tokens and space-filling curves are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
