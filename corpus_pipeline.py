"""Corpus pipeline: toxicity, line dedup, near-dedup, decontamination, encoding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationlake.llm.common import stored, table
from stationlake.llm.op3_sentencepiece import encoding_stage
from stationlake.llm.op4_decontaminate import decontamination_stage
from stationlake.llm.op5_toxicity import toxicity_stage
from stationlake.llm.op6_minhash import near_dedup_stage
from stationlake.llm.op10_line_dedup import line_dedup_stage

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

#: A trained classifier and an iterative grouping have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
