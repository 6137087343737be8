"""Incremental backlog: files that have not been processed yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dupelens.functions.mapping import DEFAULT_FORMAT, DEFAULT_SOURCE, format_from_id, format_from_role
from dupelens.sources import catalogs


def unprocessed(files: DataFrame, processed: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Files without a processed row on (asset, file); with ``retry_errors`` also those that failed.

    ``processed`` has one row per key, so dropping its failed rows first turns the retry rule
    ("unmatched or failed") into the same anti join.
    """
    done = processed.where("any_error = 0") if retry_errors else processed
    return files.join(done.select("asset_id", "file_key"), ["asset_id", "file_key"], "left_anti")


def processing_state(fingerprints: DataFrame) -> DataFrame:
    """One row per (asset, file) of a fingerprint table, with a flag for any failed attempt."""
    failed = F.when(F.col("processing_status") == "ERROR", 1).otherwise(0)
    return fingerprints.groupBy("asset_id", "file_key").agg(F.max(failed).alias("any_error"))


def backlog(source: str, tables: dict[str, DataFrame], processed: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Backlog of one source. The anti join comes before the pick of the newest file per format, so an
    older file takes over once the newest one is done."""
    asset, asset_map, asset_file = tables["asset"], tables["asset_map"], tables["asset_file"]
    name = source.lower()
    if name == "catalog_a":
        files = catalogs.files_of_a(asset, asset_map, asset_file).withColumn("file_format", format_from_role("role"))
    elif name == "catalog_b":
        files = catalogs.files_of_b(asset, asset_map, asset_file, tables["asset_format"]).withColumn(
            "file_format", format_from_id("format_id")
        )
    else:
        raise ValueError(f"unknown source {source!r}: expected 'catalog_a' or 'catalog_b'")
    todo = unprocessed(files, processed, retry_errors)
    return catalogs.as_backlog(catalogs.latest_per_format(todo, "file_format"), name)


def with_defaults(backlog_rows: DataFrame) -> DataFrame:
    """Missing format, size or source replaced by the defaults."""
    return backlog_rows.select(
        "asset_id",
        "file_key",
        F.coalesce("file_format", F.lit(DEFAULT_FORMAT)).alias("file_format"),
        F.coalesce("file_size", F.lit(0)).alias("file_size"),
        F.coalesce("source", F.lit(DEFAULT_SOURCE)).alias("source"),
    )
