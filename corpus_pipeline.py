"""From raw documents to packed sequences: filter, dedup lines and documents, mix, pack.

Every stage is written to the shared folder and read again by the next, so a lost executor
costs at most one stage's own work. What a stage wrote on the way, and the stage before it, are
deleted then.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayposts.llm import lines, mixing, near, packing, quality
from wayposts.sources.shared_folder import release, settled

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.unrepeated_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

# Packing needs a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *written, (_, last) = STAGES
    for name, stage in written:
        before = docs
        docs = settled(lambda: stage(spark, before, sf_dir), f"pipeline-{name}")
        # the given table is none that was written here, and stays
        release(before)
    return last(spark, docs, sf_dir)
