"""The corpus pipeline: stages over ``documents``, each stored before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import shared, stages

STAGES = [
    ("language ID", stages.identify_language),
    ("line dedup", stages.drop_repeated_lines),
    ("n-gram Jaccard join", stages.keep_one_of_similar),
    ("benchmark decontamination", stages.drop_contaminated),
    ("best-fit packing", stages.pack_sequences),
]
ORACLE_SQL = None  # a trained model, edit distances and a tokenizer: tested by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        after = shared.new_path(spark, name.replace(" ", "-"))
        with shared.scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(after)
        if before:
            shared.remove(spark, before)
        before, docs = after, spark.read.parquet(after)
    return docs
