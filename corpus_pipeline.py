"""The corpus pipeline: raw documents to packed training sequences.

Each stage's result is written as Parquet and read again as the next one's
documents, so a lost executor costs the tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsflow.llm import stages
from newsflow.llm.common import stored, table

STAGES = [
    ("language", stages.language),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("secrets", stages.secrets),
    ("pack", stages.pack),
]

#: the stages learn models and walk at random: not SQL; the tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
