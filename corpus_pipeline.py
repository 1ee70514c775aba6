"""The corpus pipeline: language, near duplicates, benchmark leaks, personal data, mixture.

Each stage is written as Parquet in the shared folder and read again as the documents of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreloom.llm import decontaminate, jaccard, langid, mixing, pii
from scoreloom.sources.tables import table
from scoreloom.sources.workspace import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    return langid.recognised(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a shingle similarity of 0.8 or more."""
    return jaccard.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data generalised to its kind."""
    return pii.sanitise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix of sources takes, with the words it takes of each."""
    return mixing.mixed(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

# The first stage is a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
