"""Corpus pipeline: quality, exact dedup, near dedup, mixing, tokenising.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next stage's docs.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitlake.llm.bpe import bpe_stage
from pitlake.llm.common import load, written
from pitlake.llm.exact_dedup import exact_dedup_stage
from pitlake.llm.minhash import near_dedup_stage
from pitlake.llm.mixing import mixing_stage
from pitlake.llm.quality import quality_stage

STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: the classifier and the tokeniser have no SQL form; tests hold the pipeline against its stages' brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each on what its predecessor wrote."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
