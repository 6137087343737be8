"""Catalog, fingerprint and pair views over the driver tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(frame: DataFrame) -> DataFrame:
    """Rows dealt to as many tasks as shuffles have: for work per row on tables that are one file with one row group. A table
    in more files than there are cores is read in parallel as it is, and nothing is moved."""
    if len(frame.inputFiles()) > frame.sparkSession.sparkContext.defaultParallelism:
        return frame
    return frame.repartition(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def is_unreadable() -> Column:
    """Files of :func:`media_of_documents` whose content counts as missing, where a fixture wants some."""
    return (F.col("format") == "mp3") & (F.pmod(F.col("asset_id").cast("bigint"), F.lit(50)) == 5)


def asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The asset dimension."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("asset_id"),
        F.when(F.col("c_custkey") % 2 == 0, 1).otherwise(3).alias("product_indicator"),
        F.when(F.col("c_nationkey") < 20, "Music").otherwise("Sfx").alias("asset_type"),
        F.concat(
            F.lower("c_mktsegment"),
            F.when(F.col("c_nationkey") % 3 == 0, " Music").otherwise(" fx"),
        ).alias("asset_sub_type"),
        F.when(F.col("c_acctbal") > 0, "ON_AIR").otherwise("OFF").alias("last_status_group"),
        F.col("c_acctbal").alias("balance"),
    )


def asset_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Internal id to external id."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("externalid")
    )


def asset_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per internal id."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("songid"),
        F.concat_ws("-", "l_partkey", "l_suppkey", "l_linenumber", "l_orderkey").alias("filekey"),
        F.when(F.col("l_returnflag") == "A", "CORE")
        .when(F.col("l_returnflag") == "N", "MP3")
        .otherwise("STEM")
        .alias("role"),
        F.col("l_shipdate").alias("createdat"),
        F.when(F.col("l_discount") <= 0.05, 1).otherwise(2).alias("resolution_format"),
        "l_linestatus",
        "l_quantity",
    )


def asset_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optional format row of a product (the left-join side)."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("product_id"), (F.col("s_nationkey") % 4).alias("format_id")
    )


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Already handled files, one row per (asset, file)."""
    files = asset_file(spark, sf_dir).where(F.col("l_linestatus") == "F")
    return (
        files.join(asset_map(spark, sf_dir), F.col("id") == F.col("songid"))
        .groupBy(F.col("externalid").alias("asset_id"), F.col("filekey").alias("file_key"))
        .agg(F.max(F.when(F.col("l_quantity") < 10, 1).otherwise(0)).alias("any_error"))
    )


def _document_source() -> Column:
    return F.when(F.col("doc_id") % 2 == 0, "catalog_a").otherwise("catalog_b")


def _mp3_text() -> Column:
    """The text of the mp3 file: every fifth document is altered at its end."""
    return F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("#mp3"))).otherwise(F.col("text"))


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a wav and an mp3 file; every fifth mp3 fingerprints differently."""
    files = F.explode(
        F.array(
            F.struct(F.lit("wav").alias("format"), F.md5("text").alias("fingerprint")),
            F.struct(F.lit("mp3").alias("format"), F.md5(_mp3_text()).alias("fingerprint")),
        )
    )
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "n_chars", files.alias("f"))
        .select(
            F.col("doc_id").cast("string").alias("asset_id"),
            F.concat_ws("-", F.col("doc_id"), F.col("f.format")).alias("file_key"),
            F.col("f.format").alias("format"),
            F.col("n_chars").cast("double").alias("duration"),
            F.col("f.fingerprint").alias("fingerprint"),
            F.col("n_chars").alias("file_size"),
            _document_source().alias("source"),
            F.when(F.col("n_chars") < 64, "ERROR").otherwise("SUCCESS").alias("processing_status"),
        )
    )


def media_of_documents(documents: DataFrame) -> DataFrame:
    """The content behind :func:`fingerprint`: asset, file, format and the whole text of the file."""
    files = F.explode(
        F.array(
            F.struct(F.lit("wav").alias("format"), F.col("text").alias("content")),
            F.struct(F.lit("mp3").alias("format"), _mp3_text().alias("content")),
        )
    )
    return (
        documents.select("doc_id", "n_chars", files.alias("f")).select(
            F.col("doc_id").cast("string").alias("asset_id"),
            F.concat_ws("-", F.col("doc_id"), F.col("f.format")).alias("file_key"),
            F.col("f.format").alias("format"),
            F.col("n_chars").cast("double").alias("duration"),
            F.col("n_chars").alias("file_size"),
            _document_source().alias("source"),
            F.when(F.col("n_chars") < 64, "ERROR").otherwise("SUCCESS").alias("processing_status"),
            F.col("f.content").alias("content"),
        )
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_of_orders(table(spark, sf_dir, "orders"))


def pairs_of_orders(orders: DataFrame) -> DataFrame:
    """Scored pairs for the analytics operators: one pair per order, so the table grows linearly."""
    other = F.floor(F.col("o_orderkey") / F.lit(10.0)).cast("bigint")
    length = F.floor(F.col("o_totalprice") / F.lit(1000.0)).cast("double")
    shift = (F.col("o_orderkey") % 7).cast("double")
    return (
        orders.withColumn("other", other)
        .select(
            F.col("o_custkey").cast("string").alias("asset_id_1"),
            F.col("other").cast("string").alias("asset_id_2"),
            F.concat_ws("-", "o_custkey", "o_orderkey").alias("file_key_1"),
            F.concat_ws("-", "other", "o_orderkey", F.lit("b")).alias("file_key_2"),
            F.when(F.col("o_custkey") % 2 == 0, "catalog_a").otherwise("catalog_b").alias("source_1"),
            F.when(F.col("other") % 2 == 0, "catalog_a").otherwise("catalog_b").alias("source_2"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "wav").otherwise("mp3").alias("format_1"),
            F.when(F.col("o_orderstatus") == "F", "wav").otherwise("mp3").alias("format_2"),
            length.alias("duration_1"),
            (length + shift).alias("duration_2"),
            F.least(
                F.lit(1.0),
                F.floor(F.col("o_totalprice") / F.lit(450.0)).cast("double") / F.lit(1000.0).cast("double"),
            ).alias("similarity"),
        )
    )


def uploads(events: DataFrame) -> DataFrame:
    """The event stream as ingest records: asset, file, size, duration, fingerprint, content type, time."""
    kind = F.col("event_type")
    fingerprint = (
        F.when(kind == "signup", F.col("props"))
        .when((kind == "purchase") & (F.col("value") < 20), F.lit(None))
        .otherwise(F.concat("props", kind))
    )
    content_type = (
        F.when(kind == "click", "audio/mpeg").when(kind == "view", "Application/WAV").when(kind == "purchase", "text/html")
    )
    return events.select(
        F.col("user_id").cast("string").alias("asset_id"),
        F.col("event_id").cast("string").alias("file_key"),
        F.when(F.col("user_id") % 2 == 0, "catalog_a").otherwise("catalog_b").alias("source"),
        F.floor(F.col("value") * F.lit(500.0)).alias("file_size"),
        F.when(kind != "error", F.col("value") * F.lit(40.0) - F.lit(200.0)).alias("duration"),
        fingerprint.alias("fingerprint"),
        content_type.alias("content_type"),
        F.col("ts").alias("created_at"),
    )
