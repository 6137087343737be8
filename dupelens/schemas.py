"""Fixed schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

FINGERPRINT = T.StructType(
    [
        T.StructField("asset_id", T.StringType(), False),
        T.StructField("file_key", T.StringType(), False),
        T.StructField("format", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("processing_status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

PAIR = T.StructType(
    [
        T.StructField("asset_id_1", T.StringType()),
        T.StructField("asset_id_2", T.StringType()),
        T.StructField("is_same_asset", T.BooleanType()),
        T.StructField("similarity", T.DoubleType()),
        T.StructField("duplicate_type", T.StringType()),
        T.StructField("file_key_1", T.StringType()),
        T.StructField("format_1", T.StringType()),
        T.StructField("source_1", T.StringType()),
        T.StructField("duration_1", T.DoubleType()),
        T.StructField("file_key_2", T.StringType()),
        T.StructField("format_2", T.StringType()),
        T.StructField("source_2", T.StringType()),
        T.StructField("duration_2", T.DoubleType()),
        T.StructField("duration_diff", T.DoubleType()),
    ]
)

DUPLICATE_ENTRY = T.StructType(
    [
        T.StructField("product_indicator", T.IntegerType()),
        T.StructField("song_id", T.StringType()),
    ]
)

DUPLICATED_ASSET = T.StructType(
    [
        T.StructField("song_id", T.IntegerType(), False),
        T.StructField("product_indicator", T.IntegerType(), False),
        T.StructField("asset_type", T.StringType(), False),
        T.StructField("duplicates", T.ArrayType(DUPLICATE_ENTRY)),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

KEY_FORMAT_PAIRS = T.ArrayType(
    T.StructType(
        [
            T.StructField("file_key", T.StringType()),
            T.StructField("format", T.StringType()),
        ]
    )
)
