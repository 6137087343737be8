"""Reading tables and keeping intermediate results in the folder that all executors share."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = "4000"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` where the cluster names it, else a folder of the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "shared")).rstrip("/")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back, so lost executors cost no earlier work."""
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of few rows, so that long ones fit in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the text (null: empty) of every row; other columns, whatever their names, are left out."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def tidy(*caches: dict) -> None:
    """At the end of a task: Python workers live on for later tasks, which need the memory of this one."""
    for cache in caches:
        cache.clear()
    pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """The rows of a count table with the greatest ``n``, as many as fit into ``most``.

    The border is found from a histogram of logarithms, a few hundred rows: no task and not the driver takes part of each
    partition, as an ordered limit would.
    """
    step = F.floor(F.log2(F.col(n) + 1) * 16).cast("int")
    room, border = most, None
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        room -= row["count"]
        if room < 0:
            break
        border = row["step"]
    return counts.where(step >= border) if border is not None else counts.limit(0)
