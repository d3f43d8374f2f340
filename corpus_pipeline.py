"""The corpus pipeline: each stage reads what the stage before it wrote as Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import classifier, jaccard_join, packing, quality_rules, suffix_dedup
from tallyhouse.llm.common import table
from tallyhouse.session import shared_folder

STAGES = [
    ("quality rules", quality_rules.stage),
    ("quality classifier", classifier.stage),
    ("n-gram Jaccard join", jaccard_join.stage),
    ("suffix-array dedup", suffix_dedup.stage),
    ("packing", packing.stage),
]

#: A trained classifier decides in the second stage, so the rows are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
