"""Session-level helpers: where intermediate tables go and how they are written."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` where the cluster names it, else a folder of the
    warehouse. Never a local temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared").rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/dupelens/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of results that several later stages read. The copy is columnar, so each reader
    still prunes its columns, and it outlives the executors that produced it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(*totals: DataFrame) -> DataFrame:
    """Columns of several single-row frames in one row."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), totals)
    return rows.agg(*(F.max(name).alias(name) for name in rows.columns))
