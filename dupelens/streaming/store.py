"""A keyed table that micro-batches add to: partitioned by the hash of the key, so a batch reads only what it touches.

Each batch writes its rows to partitions of its own, ``bucket`` by ``batch_id``, and replaces just these when it is replayed.
Batches are never rewritten; :meth:`KeyedStore.compact` folds all rows up to a batch into one snapshot, a single row per key,
and then names it in a small table. Readers take the last named snapshot and the batches after it, so a snapshot that was lost
on the way is not seen, and the files of folded batches can be removed by age.

Of several rows of a key the one that is greatest in ``order`` counts (then in the other columns), whatever the order
of arrival.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dupelens.runtime import fresh_path
from dupelens.sinks.tables import latest_rows

SNAPSHOTS = "upto bigint, folder string"


@dataclass(frozen=True)
class KeyedStore:
    """``schema`` without the two partition columns; ``key`` are expressions over its columns."""

    path: str
    schema: T.StructType
    key: tuple[Column, ...]
    order: tuple[str, ...] = ()
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int").alias("bucket")

    def _stored(self) -> T.StructType:
        extra = [T.StructField("bucket", T.IntegerType()), T.StructField("batch_id", T.LongType())]
        return T.StructType([*self.schema.fields, *extra])

    def _prepared(self, spark: SparkSession) -> None:
        spark.createDataFrame([], self._stored()).write.mode("ignore").partitionBy("bucket", "batch_id").parquet(self.path)
        spark.createDataFrame([], SNAPSHOTS).write.mode("ignore").parquet(f"{self.path}_snapshots")

    def _snapshot(self, spark: SparkSession, before: int | None) -> tuple[int, str | None]:
        named = spark.read.schema(SNAPSHOTS).parquet(f"{self.path}_snapshots")
        if before is not None:
            named = named.where(F.col("upto") < before)
        last = named.orderBy(F.desc("upto"), "folder").limit(1).collect()
        return (last[0]["upto"], last[0]["folder"]) if last else (-1, None)

    def rows(self, spark: SparkSession, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows of batches before ``before`` in the asked ``buckets``; other partitions are not read."""
        self._prepared(spark)
        upto, folder = self._snapshot(spark, before)
        found = spark.read.schema(self._stored()).parquet(self.path).where(F.col("batch_id") > upto)
        if before is not None:
            found = found.where(F.col("batch_id") < before)
        if folder:
            found = found.unionByName(spark.read.schema(self._stored()).parquet(folder))
        return found if buckets is None else found.where(F.col("bucket").isin(list(buckets)))

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the keys of ``rows``: at most as many numbers as there are buckets."""
        return sorted(row["bucket"] for row in rows.select(self.bucket()).distinct().collect())

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Stores the rows of a batch in place of what an earlier attempt of it stored."""
        self._prepared(rows.sparkSession)
        placed = rows.select(*self.schema.names, self.bucket(), F.lit(batch_id).cast("bigint").alias("batch_id"))
        # A bucket's rows of a batch lie in one file, or in several where they are too many for one task.
        (
            placed.hint("rebalance", "bucket")
            .write.partitionBy("bucket", "batch_id")
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(self.path)
        )

    def latest(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """One row per key."""
        names = [f"_key_{i}" for i in range(len(self.key))]
        keyed = self.rows(spark, before).select(*self.schema.names, *(k.alias(n) for k, n in zip(self.key, names, strict=True)))
        return latest_rows(keyed, names, self.order).select(*self.schema.names)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Folds the batches up to ``upto`` into a snapshot."""
        if self._snapshot_of(spark, upto):
            return
        folder = fresh_path(spark, "snapshot")
        rows = self.latest(spark, upto + 1).select("*", self.bucket(), F.lit(upto).cast("bigint").alias("batch_id"))
        rows.hint("rebalance", "bucket").write.partitionBy("bucket", "batch_id").parquet(folder)
        spark.createDataFrame([(upto, folder)], SNAPSHOTS).coalesce(1).write.mode("append").parquet(f"{self.path}_snapshots")

    def _snapshot_of(self, spark: SparkSession, upto: int) -> bool:
        self._prepared(spark)
        return self._snapshot(spark, upto + 1)[0] == upto
