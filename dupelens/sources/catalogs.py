"""Files of the two catalogs: joins, latest file per format, per-asset summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dupelens.functions.mapping import AUDIO_ROLES, format_from_id, format_from_role

# Catalog predicates.
MUSIC_TYPE = "Music"
MUSIC_SUB_TYPE = "%music%"
MAIN_RESOLUTION = 1


def assets_of_a(asset: DataFrame) -> DataFrame:
    return asset.where((F.col("product_indicator") == 1) & (F.col("asset_type") == MUSIC_TYPE)).select("asset_id")


def assets_of_b(asset: DataFrame) -> DataFrame:
    return asset.where((F.col("product_indicator") == 3) & F.col("asset_sub_type").ilike(MUSIC_SUB_TYPE)).select(
        "asset_id"
    )


def join_files(assets: DataFrame, asset_map: DataFrame, asset_file: DataFrame) -> DataFrame:
    """asset -> internal id -> file, all inner. Filters on either side reach their scans."""
    return assets.join(asset_map, F.col("asset_id") == F.col("externalid")).join(
        asset_file, F.col("id") == F.col("songid")
    )


def files_of_a(asset: DataFrame, asset_map: DataFrame, asset_file: DataFrame) -> DataFrame:
    """asset_id, file_key, role, created_at of catalog A's audio files."""
    audio = asset_file.where(F.col("role").isin(*AUDIO_ROLES))
    return join_files(assets_of_a(asset), asset_map, audio).select(
        "asset_id", F.col("filekey").alias("file_key"), "role", F.col("createdat").alias("created_at")
    )


def files_of_b(asset: DataFrame, asset_map: DataFrame, asset_file: DataFrame, asset_format: DataFrame) -> DataFrame:
    """asset_id, file_key, format_id (null where the product has no format row), created_at of catalog B."""
    main = asset_file.where(F.col("resolution_format") == MAIN_RESOLUTION)
    files = join_files(assets_of_b(asset), asset_map, main)
    return files.join(asset_format, F.col("asset_id") == F.col("product_id"), "left").select(
        "asset_id", F.col("filekey").alias("file_key"), "format_id", F.col("createdat").alias("created_at")
    )


def latest_per_format(files: DataFrame, format_col: str) -> DataFrame:
    """Newest file of each (asset, format); equal times fall back to the lower key.

    ``row_number() = 1`` lets Spark keep one row per key and map task before the shuffle, so a key with
    very many files costs one row per task.
    """
    newest = Window.partitionBy("asset_id", format_col).orderBy(F.desc("created_at"), "file_key")
    return files.withColumn("rn", F.row_number().over(newest)).where("rn = 1").drop("rn")


def format_summary(files: DataFrame, format_col: str) -> DataFrame:
    """Per asset: number of files, keys, formats, (key, format) objects and a format -> key map.

    ``files`` holds one row per (asset, format), which bounds every list by the number of formats.
    """
    entry = F.struct(F.col(format_col).alias("format"), F.col("file_key"))
    grouped = files.groupBy("asset_id").agg(
        F.count(F.lit(1)).alias("num_file_keys"), F.sort_array(F.collect_list(entry)).alias("entries")
    )
    return grouped.select(
        "asset_id",
        "num_file_keys",
        F.col("entries.file_key").alias("file_keys"),
        F.col("entries.format").alias("formats"),
        F.transform("entries", lambda e: F.struct(e["file_key"].alias("file_key"), e["format"].alias("format"))).alias(
            "key_format_pairs"
        ),
        F.map_from_entries("entries").alias("format_to_file_key"),
    )


def top_assets(summary: DataFrame, limit: int = 100) -> DataFrame:
    """The ``limit`` assets with most files."""
    return summary.orderBy(F.desc("num_file_keys"), "asset_id").limit(limit)


def summary_of_a(asset, asset_map, asset_file, limit: int = 100) -> DataFrame:
    files = latest_per_format(files_of_a(asset, asset_map, asset_file), "role")
    return top_assets(format_summary(files, "role"), limit)


def summary_of_b(asset, asset_map, asset_file, asset_format, limit: int = 100) -> DataFrame:
    files = files_of_b(asset, asset_map, asset_file, asset_format)
    files = files.withColumn("format", F.upper(format_from_id("format_id", default=None))).where(
        F.col("format").isNotNull()
    )
    return top_assets(format_summary(latest_per_format(files, "format"), "format"), limit)


def files_for_assets(asset, asset_map, asset_file, asset_format, asset_ids: DataFrame) -> DataFrame:
    """All files of the requested ids in both catalogs."""
    wanted = asset.join(asset_ids.select("asset_id").distinct(), "asset_id", "left_semi")
    from_a = files_of_a(wanted, asset_map, asset_file).withColumn("file_format", format_from_role("role"))
    from_b = files_of_b(wanted, asset_map, asset_file, asset_format).withColumn(
        "file_format", format_from_id("format_id")
    )
    return as_backlog(from_a, "catalog_a").unionByName(as_backlog(from_b, "catalog_b"))


def as_backlog(files: DataFrame, source: str) -> DataFrame:
    return files.select(
        "asset_id", "file_key", "file_format", F.lit(0).alias("file_size"), F.lit(source).alias("source")
    )


def parse_ids(spark, text: str) -> DataFrame:
    """Ids of a comma list, trimmed; an empty text gives no rows."""
    return (
        spark.range(1)
        .select(F.explode(F.split(F.lit(text), ",")).alias("raw"))
        .select(F.trim("raw").alias("asset_id"))
        .where("asset_id <> ''")
    )
