"""File exports: CSV with JSON-encoded nested columns, JSON lines, bundles per bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat(rows: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return rows.select(
        *(
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in rows.schema.fields
        )
    )


def to_csv(rows: DataFrame, path: str) -> None:
    flat(rows).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def to_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def bundle(rows: DataFrame, path: str, by: str = "bucket") -> None:
    rows.write.mode("overwrite").partitionBy(by).json(path)
