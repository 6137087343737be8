"""Sizes of the pair space of duration clusters, counted without making the pairs.

A cluster of n records has n (n - 1) / 2 unordered pairs; those that share a property are counted from the
sizes of the groups with equal values. All results are therefore linear in the records, whatever the
cluster sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIRS = "sum(n * (n - 1) div 2)"


def _equal_pairs(records: DataFrame, columns: list[str], out: str) -> DataFrame:
    """Pairs per cluster that agree in all of ``columns``."""
    groups = records.groupBy("cluster_start", *columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.groupBy("cluster_start").agg(F.expr(PAIRS).alias(out))


def cluster_pairs(records: DataFrame) -> DataFrame:
    """Per cluster: records and pairs, by mode and by reason for not comparing them.

    Columns: all, cross-source and same-source pairs of different files, pairs of the same file, of the
    same asset in different files, and the pairs left to compare.
    """
    per_source = records.groupBy("cluster_start", "source").agg(F.count(F.lit(1)).alias("n"))
    totals = per_source.groupBy("cluster_start").agg(
        F.sum("n").alias("records"), F.expr(PAIRS).alias("same_source_all")
    )
    joined = totals
    for columns, out in (
        (["file_key"], "same_file"),
        (["file_key", "source"], "same_file_source"),
        (["asset_id"], "asset_all"),
        (["asset_id", "file_key"], "asset_file"),
    ):
        joined = joined.join(_equal_pairs(records, columns, out), "cluster_start")
    every: Column = F.expr("records * (records - 1) div 2")
    pairs_all = every - F.col("same_file")
    same_source = F.col("same_source_all") - F.col("same_file_source")
    same_asset = F.col("asset_all") - F.col("asset_file")
    return joined.select(
        "cluster_start",
        "records",
        pairs_all.alias("pairs_all"),
        (pairs_all - same_source).alias("pairs_cross_source"),
        same_source.alias("pairs_same_source"),
        F.col("same_file").alias("skipped_same_file"),
        same_asset.alias("skipped_same_asset"),
        (pairs_all - same_asset).alias("compared"),
    )


def skip_reasons(counts: DataFrame) -> DataFrame:
    """Number of pairs per reason over all clusters."""
    reasons = F.explode(
        F.array(
            F.struct(F.lit("same_file").alias("reason"), F.col("skipped_same_file").alias("pairs")),
            F.struct(F.lit("same_asset").alias("reason"), F.col("skipped_same_asset").alias("pairs")),
            F.struct(F.lit("compared").alias("reason"), F.col("compared").alias("pairs")),
        )
    )
    return (
        counts.select(reasons.alias("r"))
        .groupBy(F.col("r.reason").alias("reason"))
        .agg(F.sum("r.pairs").alias("pairs"))
    )
