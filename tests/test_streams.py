"""Streams into keyed stores: later rows count, replays change nothing, batches read only the partitions they touch."""

import pytest
from pyspark.sql import functions as F

from dupelens.runtime import fresh_path
from dupelens.schemas import PAIR
from dupelens.sinks import tables
from dupelens.streaming import ingest
from tests.test_tables import pair

RECORD = "asset_id string, file_key string, status string, at int"


def records(spark, rows):
    return spark.createDataFrame(rows, RECORD)


def test_upsert_takes_the_latest_by_a_column(spark):
    current = records(spark, [("1", "a", "old", 5), ("1", "b", "kept", 5), ("2", "c", "null time", None)])
    changes = records(spark, [("1", "a", "A", 7), ("1", "a", "Z", 6), ("1", "b", "late", 4), ("2", "c", "new", 1), ("3", "d", "added", 1)])
    found = tables.upsert(current, changes, ["asset_id", "file_key"], ["at"])
    assert {tuple(r) for r in found.collect()} == {("1", "a", "A", 7), ("1", "b", "kept", 5), ("2", "c", "new", 1), ("3", "d", "added", 1)}
    assert found.columns == ["asset_id", "file_key", "status", "at"]


def test_ingest_over_batches_with_updates_of_earlier_keys(spark, tmp_path):
    source, state = str(tmp_path / "in"), fresh_path(spark, "state")
    store = ingest.records_store(fresh_path(spark, "store"), records(spark, []).schema, ["asset_id", "file_key"], ["at"])
    drops = [
        [("1", "a", "ERROR", 1), ("1", "b", "SUCCESS", 1)],
        [("1", "a", "SUCCESS", 2), ("2", "c", "ERROR", 2)],
        [("2", "c", "SUCCESS", 3), ("1", "b", "stale", 0)],
        [("1", "a", "AGAIN", 4)],
    ]
    for drop in drops:
        records(spark, drop).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(source)
        ingest.ingest(stream, lambda batch: batch, store, state, compact_every=2)
    expected = {("1", "a", "AGAIN", 4), ("1", "b", "SUCCESS", 1), ("2", "c", "SUCCESS", 3)}
    assert {tuple(r) for r in store.latest(spark).collect()} == expected
    # Batches 0 and 1 are folded: one row per key, the later batches as they came.
    assert store.rows(spark).count() == 3 + 2 + 1
    store.put(records(spark, drops[3]), 3)
    assert {tuple(r) for r in store.latest(spark).collect()} == expected


def test_a_lost_snapshot_is_not_seen(spark):
    store = ingest.records_store(fresh_path(spark, "store"), records(spark, []).schema, ["asset_id", "file_key"], ["at"])
    for i in range(3):
        store.put(records(spark, [("1", "a", f"v{i}", i), (str(i), "b", "x", i)]), i)
    store.compact(spark, 1)
    store.compact(spark, 1)
    assert spark.read.parquet(f"{store.path}_snapshots").count() == 1
    assert {r.status for r in store.latest(spark).where("file_key = 'a'").collect()} == {"v2"}
    # Readers of the time before the snapshot read the batches themselves.
    assert store.rows(spark, before=1).count() == 2
    assert store.latest(spark, before=2).where("file_key = 'a'").first().status == "v1"


@pytest.mark.parametrize("every", [0, 1, 2])
def test_pairs_of_many_batches_are_stored_once(spark, tmp_path, every):
    source, out, state = str(tmp_path / "in"), fresh_path(spark, "pairs"), fresh_path(spark, "state")
    for i in range(4):
        rows = [pair(str(i), "a", str(i + 1), "b"), pair("x", "a", "y", "b"), pair(str(i), "b", str(i - 1), "a")]
        spark.createDataFrame(rows, PAIR).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(PAIR).option("maxFilesPerTrigger", 1).parquet(source)
    ingest.upload_pairs(stream, out, state, compact_every=every)
    ends = [frozenset([(r.asset_id_1, r.file_key_1), (r.asset_id_2, r.file_key_2)]) for r in ingest.read_batches(spark, out, PAIR).collect()]
    expected = {frozenset([(str(i), "a"), (str(i + 1), "b")]) for i in range(-1, 4)} | {frozenset([("x", "a"), ("y", "b")])}
    assert len(ends) == len(set(ends)) and set(ends) == expected


def test_a_replayed_batch_gives_the_same_rows(spark):
    store = ingest.pair_store(fresh_path(spark, "pairs"))
    first = spark.createDataFrame([pair("1", "a", "2", "b"), pair("3", "c", "4", "d")], PAIR)
    second = spark.createDataFrame([pair("2", "b", "1", "a"), pair("5", "e", "6", "f"), pair("6", "f", "5", "e", 0.5)], PAIR)
    store.put(ingest.upload_batch(store, first, 0), 0)
    for _ in range(2):
        store.put(ingest.upload_batch(store, second, 1), 1)
    assert store.rows(spark).count() == 3
    assert store.rows(spark).where("batch_id = 1").count() == 1


def test_a_batch_reads_only_the_buckets_it_touches(spark):
    store = ingest.pair_store(fresh_path(spark, "pairs"))
    many = [pair(str(i), "a", str(i + 1), "b") for i in range(300)]
    store.put(spark.createDataFrame(many, PAIR), 0)
    batch = spark.createDataFrame([pair("1", "b", "0", "a"), pair("900", "a", "901", "b")], PAIR)
    touched = store.touched(batch)
    assert 1 <= len(touched) <= 2
    fresh = ingest.upload_batch(store, batch, 1)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    found = store.rows(spark, before=1, buckets=touched)
    assert {r.bucket for r in found.select("bucket").distinct().collect()} <= set(touched)
    assert len(found.inputFiles()) <= 64 and found.select(F.input_file_name()).distinct().count() <= len(touched)
    assert [r.asset_id_1 for r in fresh.collect()] == ["900"]
