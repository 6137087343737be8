"""Ad-hoc parametrised SQL over named DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run(spark: SparkSession, text: str, args: dict | None = None, **views: DataFrame) -> DataFrame:
    """Runs ``text`` with named parameters (``:name``); ``{view}`` refers to the passed DataFrames."""
    return spark.sql(text, args=args or {}, **views)
