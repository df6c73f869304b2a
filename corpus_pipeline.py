"""The text pipeline: each stage takes all that the one before it kept.

Quality rules drop documents, line dedup and decontamination drop lines and documents, the Jaccard join leaves one
document of each group, and the mix draws words from the sources by their target weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadspark.llm.decontamination import decontaminate
from leadspark.llm.jaccard_join import similar_components
from leadspark.llm.line_dedup import dedup_lines
from leadspark.llm.mixing import mix_sources
from leadspark.llm.quality import judge_quality, measured
from leadspark.session import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or whose posterior quality is low go."""
    return judge_quality(measured(docs)).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines with an earlier near copy go, short ones with an earlier equal one, and with them documents of which no word is left."""
    kept = dedup_lines(docs).where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.col("n_removed") > 0
    columns = {"text": F.col("kept_text"), "n_chars": F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))}
    return kept.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that links join, the one of smallest ``doc_id`` stays; those without an id stay too.

    Of rows with one ``doc_id`` and equal texts, one stays. The stage takes five words and a similarity of 0.8.
    """
    linked = similar_components(docs, words=5, percent=80)
    others = linked.where("component_id != doc_id").select(F.col("doc_id").alias("_other")).distinct()
    rest = docs.join(others, docs["doc_id"] == others["_other"], "left_anti")
    return rest.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(rest.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, items).where("not contaminated").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes words, with the number it takes."""
    return mix_sources(docs).where("taken > 0")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL cannot express the label model. The stages' operators are each tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
