"""From documents to packed token sequences: the stages and the function that runs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import stages
from ledgerlens.llm.tables import table
from ledgerlens.sources.staging import staged

STAGES = [
    ("language", stages.identify_language),
    ("near_duplicates", stages.drop_near_duplicates),
    ("decontamination", stages.decontaminated),
    ("secrets", stages.redact_secrets),
    ("packing", stages.packed),
]

#: Tokenization and alignment have no SQL form; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed corpus; what each stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
