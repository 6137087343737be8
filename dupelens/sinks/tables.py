"""Result tables: DDL, full refresh, append, upsert and idempotent pair upload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dupelens.operators.pairs import KEY_NAMES, unordered_key
from dupelens.runtime import fresh_path
from dupelens.schemas import DUPLICATED_ASSET, FINGERPRINT, PAIR
from dupelens.sources.pair_files import CORRUPT, is_error

TABLES = {
    "audio_fingerprint": FINGERPRINT,
    "audio_detected_duplicates": T.StructType([*PAIR.fields, T.StructField("created_at", T.TimestampType())]),
    "duplicated_assets": DUPLICATED_ASSET,
}


def create_tables(spark: SparkSession, database: str = "default") -> None:
    """Creates the three tables where they are missing. Keys are checked by queries, not by the table."""
    for name, schema in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def full_refresh(rows: DataFrame, table: str) -> None:
    """Replaces the content of ``table``: writes a fresh path, then points the table to it.

    Readers see the old rows or the new ones; a job that is lost on the way leaves the table as it was. The old
    files stay for readers that hold them; the caller removes them.
    """
    spark = rows.sparkSession
    path = fresh_path(spark, table.replace(".", "-"))
    rows.write.parquet(path)
    if spark.catalog.tableExists(table):
        swap_location(spark, table, path)
    else:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")


def append(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    rows.write.mode("append").format(fmt).save(path)


def latest_rows(rows: DataFrame, keys: list[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by the ``order`` columns, then by all other columns, whatever the order of the input.
    A null counts as the least value."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    ranked = F.max(F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(order)), F.struct(*rest).alias("row")))
    return rows.groupBy(*keys).agg(ranked.alias("latest")).select(*keys, "latest.row.*").select(*rows.columns)


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], order: Sequence[str] = ()) -> DataFrame:
    """``current`` with the rows of ``changes`` in place of those with equal keys.

    A key that ``changes`` holds several times counts once, with the row that is latest by the ``order`` columns (without any:
    the greatest of its rows, all other columns in order). With ``order`` a change that is older than the current row does not
    replace it. Write the result to a new location and point the table to it (:func:`swap_location`).
    """
    if order:
        return latest_rows(current.unionByName(changes), keys, order)
    latest = latest_rows(changes, keys)
    return current.join(latest.select(*keys), keys, "left_anti").unionByName(latest)


def swap_location(spark: SparkSession, table: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def split_upload(lines: DataFrame, stored: DataFrame) -> DataFrame:
    """Lines of a result file with their fate: ``uploaded``, ``skipped`` (already stored, or named by an earlier line, in
    either orientation) or ``errors``. Of lines with one pair the least in the order of all their columns is uploaded."""
    keyed = lines.withColumn("is_error", is_error()).select("*", *unordered_key())
    known = stored.select(*unordered_key()).distinct().withColumn("known", F.lit(True))
    good = keyed.where("not is_error")
    once = Window.partitionBy(*KEY_NAMES).orderBy(*(c for c in lines.columns if c != CORRUPT))
    fates = good.withColumn("turn", F.row_number().over(once)).join(known, KEY_NAMES, "left").withColumn(
        "fate", F.when(F.col("known") | (F.col("turn") > 1), "skipped").otherwise("uploaded")
    )
    broken = keyed.where("is_error").withColumn("fate", F.lit("errors"))
    return fates.select(*lines.columns, "fate").unionByName(broken.select(*lines.columns, "fate"))


def new_rows(split: DataFrame) -> DataFrame:
    return split.where("fate = 'uploaded'").drop("fate", CORRUPT)


def upload_counts(split: DataFrame) -> DataFrame:
    return split.agg(*(F.count_if(F.col("fate") == name).alias(name) for name in ("uploaded", "skipped", "errors")))
