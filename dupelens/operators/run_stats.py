"""Statistics of the ingest table and of runs, derived from the rows themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _succeeded() -> Column:
    return F.col("processing_status") == "SUCCESS"


def processing_stats(fingerprints: DataFrame) -> DataFrame:
    return fingerprints.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(_succeeded()).alias("successful"),
        F.count_if(F.col("processing_status") == "ERROR").alias("failed"),
        F.round(F.avg(F.when(_succeeded(), F.col("duration"))), 6).alias("avg_duration"),
        F.min("created_at").alias("first_processed"),
        F.max("created_at").alias("last_processed"),
    )


def run_summary(ingested: DataFrame, elapsed_seconds: float) -> DataFrame:
    counts = ingested.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(_succeeded()).alias("successful"),
        F.count_if(~_succeeded()).alias("failed"),
    )
    rate = F.col("processed") / F.lit(elapsed_seconds) if elapsed_seconds > 0 else F.lit(0.0)
    return counts.withColumn(
        "success_rate", F.coalesce(F.try_divide(F.col("successful") * 100.0, F.col("processed")), F.lit(0.0))
    ).withColumn("rate_per_second", rate)


def platform_summary(results: DataFrame, platforms: list[str]) -> DataFrame:
    """Success of any platform, per-platform success and counts, and their total."""
    done = {name: F.count_if((F.col("source") == name) & _succeeded()) for name in platforms}
    return results.agg(
        F.coalesce(F.bool_or(_succeeded()), F.lit(False)).alias("overall_success"),
        *((count > 0).alias(f"{name}_success") for name, count in done.items()),
        F.count_if(_succeeded() & F.col("source").isin(platforms)).alias("total_downloads"),
        *(count.alias(f"{name}_downloads") for name, count in done.items()),
    )
