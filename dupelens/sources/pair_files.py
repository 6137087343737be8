"""Pair results in JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dupelens.schemas import PAIR

CORRUPT = "_corrupt_record"
REQUIRED = ("asset_id_1", "file_key_1", "asset_id_2", "file_key_2", "similarity")


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """All lines, with the raw text of malformed ones in ``_corrupt_record``."""
    schema = T.StructType([*PAIR.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def is_error() -> Column:
    """Malformed lines, and records without one of the required fields."""
    missing = [F.col(name).isNull() for name in REQUIRED]
    test = F.col(CORRUPT).isNotNull()
    for part in missing:
        test = test | part
    return test
