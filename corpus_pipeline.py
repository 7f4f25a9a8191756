"""A training corpus from raw documents: toxicity, near-duplicates, secrets, source mix, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame. What a stage keeps is written to
Parquet in the folder that all executors share and read again by the next one. All stages but the
last give the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidelake.llm import mixing, packing, secrets, simhash, toxicity
from tidelake.llm.common import table
from tidelake.session import shared_dir


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.3."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the smallest doc_id."""
    return simhash.keep_first(docs)


def secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them; the one on a source's edge is cut."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("simhash_near_dedup", near_copies_out),
    ("secret_scan", secrets_out),
    ("mixing", mixed),
    ("packing", packed),
]

#: Stages train models, hash and tokenize, which SQL can't express; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over documents."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
