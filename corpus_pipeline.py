"""Training-data pipeline over the table `documents`: each stage applies one operator of odspark.llm to all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odspark.llm import decontamination, ngram_join, quality_rules, secret_scan, sentencepiece_codec
from odspark.llm.common import stored, table

#: (name, function(spark, docs, sf_dir) -> DataFrame); all but the last return the columns of `documents`.
STAGES = [
    ("quality_rules", quality_rules.stage),
    ("ngram_jaccard_join", ngram_join.stage),
    ("decontamination", decontamination.stage),
    ("secret_scan", secret_scan.stage),
    ("sentencepiece", sentencepiece_codec.stage),
]

#: SentencePiece encoding has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
