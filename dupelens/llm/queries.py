"""The registered queries of this package: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from dupelens.llm import (
    context_tree,
    decontamination,
    filter_audit,
    fingerprints,
    html_extraction,
    jaccard_join,
    license_scan,
    sentencepiece_lattice,
    sharding,
    token_counts,
    toxicity,
    warc,
    whitening,
)
from dupelens.llm.tables import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_likeness(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_lattice.encoded(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_links(table(spark, sf_dir, "documents"), jaccard_join.Rule(words=3, percent=90))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.scores(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SPARK = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_fingerprints,
        op3_html_extraction,
        op4_toxicity,
        op5_sentencepiece,
        op6_ngram_jaccard_join,
        op7_sharding,
        op8_token_counts,
        op9_lm_scoring,
        op10_decontamination,
        op11_warc_revisits,
        op12_embedding_whitening,
        op13_filter_audit,
    )
} | {"pipeline": corpus_pipeline.run}

SQL: dict[str, str] = {"op11_warc_revisits": warc.SQL, "op13_filter_audit": filter_audit.SQL}
