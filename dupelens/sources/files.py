"""Listing of media files in a folder tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEDIA_GLOB = "*.{mp3,wav}"


def list_files(spark: SparkSession, folder: str, pattern: str = MEDIA_GLOB) -> DataFrame:
    """Files whose name matches ``pattern``, with their size, suffix and the folder as source.

    Only metadata columns are read, so no file content is loaded.
    """
    path = F.split("path", "/")
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(
            F.element_at(path, -1).alias("file_name"),
            F.element_at(path, -2).alias("source"),
            F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).alias("format"),
            F.col("length").alias("file_size"),
        )
    )
