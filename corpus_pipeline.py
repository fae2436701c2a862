"""From raw documents to packed training windows: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import decontaminate, packing, pii, prefix_tree, quality
from adlake.llm.common import by_ids, table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; see adlake/llm/quality.py."""
    return quality.QualityModel(docs, table(spark, sf_dir, "labels")).accepted(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest key of each group of near duplicates stays.

    Of equal rows with that key one stays, different texts of one key all stay, and rows
    without a key stay.
    """
    groups = written(prefix_tree.near_components(docs), "groups")
    gone = written(groups.where("doc_id != component_id").select(F.col("doc_id").alias("id")).distinct(), "gone")
    kept = by_ids(docs, "doc_id", gone, "left_anti")
    again = written(groups.where("doc_id = component_id").groupBy(F.col("doc_id").alias("id"))
                    .agg(F.count("*").alias("same")).where("same > 1").select("id"), "again")
    if again.isEmpty():
        return kept
    once = by_ids(kept, "doc_id", again, "left_anti")
    return once.unionByName(by_ids(kept, "doc_id", again, "left_semi").dropDuplicates(["doc_id", "text"]))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the text."""
    return pii.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows; see adlake/llm/packing.py."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", no_benchmark),
    ("personal data", no_personal_data),
    ("packing", packed),
]
# The classifier, the field and the tokenizer are beyond SQL; the tests hold the stages against
# plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
