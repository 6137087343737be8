"""Readers of the fingerprint table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(fingerprints: DataFrame) -> DataFrame:
    """Successful records with a fingerprint and a positive duration; the filters reach the scan."""
    return fingerprints.where(
        (F.col("processing_status") == "SUCCESS") & F.col("fingerprint").isNotNull() & (F.col("duration") > 0)
    )


def scan(fingerprints: DataFrame) -> DataFrame:
    """Input of exact detection, in (source, asset) order."""
    return (
        usable(fingerprints)
        .select("asset_id", "file_key", "format", "duration", "fingerprint", "source")
        .orderBy("source", "asset_id")
    )


def scan_by_duration(fingerprints: DataFrame) -> DataFrame:
    """Input of fuzzy detection, in (duration, source, asset) order, with missing sizes as 0."""
    return (
        usable(fingerprints)
        .select(
            "asset_id",
            "file_key",
            "format",
            "duration",
            "fingerprint",
            F.coalesce("file_size", F.lit(0)).alias("file_size"),
            "source",
        )
        .orderBy("duration", "source", "asset_id")
    )


def lookup(fingerprints: DataFrame, asset_ids: DataFrame) -> DataFrame:
    """Fingerprint per (asset, source, format) of the requested ids; the last file key wins."""
    newest = Window.partitionBy("asset_id", "source", "format").orderBy(F.desc("file_key"))
    return (
        _successful(fingerprints)
        .join(asset_ids.select("asset_id").distinct(), "asset_id", "left_semi")
        .withColumn("rn", F.row_number().over(newest))
        .where("rn = 1")
        .select("asset_id", "source", "format", "fingerprint")
    )


def first_file(fingerprints: DataFrame, asset_ids: DataFrame) -> DataFrame:
    """First file key of each requested asset."""
    return (
        fingerprints.where(F.col("processing_status") == "SUCCESS")
        .join(asset_ids.select("asset_id").distinct(), "asset_id", "left_semi")
        .groupBy("asset_id")
        .agg(F.min("file_key").alias("file_key"))
    )


def lookup_one(fingerprints: DataFrame, asset_id: str) -> DataFrame:
    """File key, source and format of one asset; empty where it is unknown."""
    return (
        _successful(fingerprints)
        .where(F.col("asset_id") == asset_id)
        .orderBy("file_key")
        .limit(1)
        .select("file_key", "source", "format")
    )


def _successful(fingerprints: DataFrame) -> DataFrame:
    return fingerprints.where((F.col("processing_status") == "SUCCESS") & F.col("fingerprint").isNotNull())
