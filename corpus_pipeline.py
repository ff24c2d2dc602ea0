"""The training-data pipeline: documents in, token ids out, one operator a stage.

Each stage works on all rows that the one before kept; ``run`` writes every stage's rows as
Parquet to the shared folder and reads them back, so a lost executor costs one stage at most.
All stages but the last return the columns of documents. Nulls, empty texts, repeated rows and
empty tables: as the operators' docstrings say; a document without words fails the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martspark.llm import bpe, line_rules, mixing, pii, simhash
from martspark.llm.common import staged, table
from martspark.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits are removed from the others."""
    return line_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.survivors(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked."""
    return pii.redact(docs, pii.train(pii.labelled_table(spark)))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number and hash of its ids, hash of the decoded bytes."""
    return bpe.encode_decode(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: The random field, SimHash and merges by rank are not for SQL; tests compare stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline/{name}")
    return docs
