"""A training corpus from raw documents: each stage's rows are the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattledger.llm import stages
from wattledger.llm.common import stored, table

STAGES = [
    ("toxicity", stages.toxicity_filter),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("source_mix", stages.source_mix),
    ("token_output", stages.token_output),
]

#: Tokenizers are outside SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
