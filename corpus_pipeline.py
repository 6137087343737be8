"""A cleaning pipeline for documents: toxicity, near copies, benchmark decontamination, SentencePiece ids.

Each stage takes what its predecessor kept, written as Parquet and read again. All but the last return the columns of
``documents``. Null texts count as empty: they are not toxic, have no near copies, match no benchmark item and no ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from dupelens.llm import decontamination, jaccard_join, sentencepiece_lattice, toxicity
from dupelens.llm.tables import shared_dir, table

#: Some stages cannot be written in SQL (a trained model, a lattice search).
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from the labels of the documents of this stage."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share 80 % of their 5-word shingles the one with the least id."""
    return jaccard_join.one_of_each(docs, jaccard_join.Rule(words=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of the documents that are left, with the scores of their best segmentations."""
    return sentencepiece_lattice.encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        path = f"{shared_dir(spark)}/pipeline/{name}-{uuid.uuid4().hex}"
        made.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
