"""Streaming ingest and pair upload: file sources, one idempotent write per micro-batch into a keyed store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dupelens.operators.pairs import KEY_NAMES, not_stored, unordered_key
from dupelens.schemas import PAIR
from dupelens.streaming.store import KeyedStore

#: Partitions of a store: batches much smaller than the table should touch few of them.
BUCKETS = 64
#: Batches between two compactions of a store.
COMPACT_EVERY = 16


def _run(source: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Everything the stream holds now, in micro-batches; their size is the source's ``maxFilesPerTrigger``."""
    query = (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _compacted(store: KeyedStore, spark: SparkSession, batch_id: int, every: int) -> None:
    """Folds the batches before this one, at fixed batch numbers, so that a replay does the same."""
    if every and batch_id and batch_id % every == 0:
        store.compact(spark, batch_id - 1)


def records_store(path: str, schema: T.StructType, keys: list[str], order: list[str], buckets: int = BUCKETS) -> KeyedStore:
    """A store of records by key columns, of which the row that is latest by ``order`` counts."""
    return KeyedStore(path, schema, tuple(F.col(k) for k in keys), tuple(order), buckets)


def pair_store(path: str, buckets: int = BUCKETS) -> KeyedStore:
    """A store of pairs, in either orientation."""
    return KeyedStore(path, PAIR, tuple(unordered_key()), (), buckets)


def ingest(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], store: KeyedStore, checkpoint: str, compact_every: int = COMPACT_EVERY
) -> None:
    """Runs ``transform`` over the stream and upserts its rows: a later row of a key takes the place of the earlier one."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _compacted(store, batch.sparkSession, batch_id, compact_every)
        store.put(batch, batch_id)

    _run(transform(source), write, checkpoint)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All pairs of the store at ``path``."""
    return pair_store(path).rows(spark).select(*schema.names)


def upload_batch(store: KeyedStore, batch: DataFrame, batch_id: int) -> DataFrame:
    """The pairs of a batch that the batches before it do not hold, in either orientation, one row per pair.

    Only the buckets of the batch's keys are read. Of rows with one pair the least by a total order is kept, so a replay gives the
    same rows again.
    """
    rows = batch.select(*PAIR.names, *unordered_key())
    once = rows.groupBy(*KEY_NAMES).agg(F.min(F.struct(*PAIR.names)).alias("row")).select("row.*")
    stored = store.rows(batch.sparkSession, before=batch_id, buckets=store.touched(batch))
    return not_stored(once, stored).select(*PAIR.names)


def upload_pairs(
    source: DataFrame, path: str, checkpoint: str, compact_every: int = COMPACT_EVERY, buckets: int = BUCKETS
) -> None:
    """Stores the pairs of the stream that the table at ``path`` does not hold yet."""
    store = pair_store(path, buckets)

    def upload(batch: DataFrame, batch_id: int) -> None:
        _compacted(store, batch.sparkSession, batch_id, compact_every)
        store.put(upload_batch(store, batch, batch_id), batch_id)

    _run(source, upload, checkpoint)
