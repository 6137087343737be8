"""Sinks, backlog and streams: what is written once stays written once."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from dupelens.operators import backlog as work
from dupelens.operators import pairs as ops
from dupelens.runtime import fresh_path
from dupelens.schemas import PAIR
from dupelens.sinks import exports, tables
from dupelens.sources import catalogs, files, fingerprints, pair_files
from dupelens.streaming import ingest


def pair(a1, f1, a2, f2, similarity=0.9):
    return (a1, a2, a1 == a2, similarity, "X", f1, "wav", "s1", 1.0, f2, "wav", "s2", 2.0, 1.0)


def test_tables_are_created_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dupelens_test")
    for _ in range(2):
        tables.create_tables(spark, "dupelens_test")
    names = {t.name for t in spark.catalog.listTables("dupelens_test")}
    assert set(tables.TABLES) <= names
    columns = spark.table("dupelens_test.duplicated_assets").dtypes
    assert ("duplicates", "array<struct<product_indicator:int,song_id:string>>") in columns
    assert ("created_at", "timestamp_ntz") in columns


def test_upsert_and_swap(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dupelens_test")
    schema = "asset_id string, file_key string, status string"
    one, two = fresh_path(spark, "v1"), fresh_path(spark, "v2")
    spark.createDataFrame([("1", "a", "ERROR"), ("1", "b", "SUCCESS")], schema).write.parquet(one)
    spark.sql("DROP TABLE IF EXISTS dupelens_test.versions")
    spark.sql(f"CREATE TABLE dupelens_test.versions ({schema}) USING parquet LOCATION '{one}'")
    changes = spark.createDataFrame([("1", "a", "SUCCESS"), ("2", "c", "SUCCESS")], schema)
    tables.upsert(spark.table("dupelens_test.versions"), changes, ["asset_id", "file_key"]).write.parquet(two)
    tables.swap_location(spark, "dupelens_test.versions", two)
    rows = {tuple(r) for r in spark.table("dupelens_test.versions").collect()}
    assert rows == {("1", "a", "SUCCESS"), ("1", "b", "SUCCESS"), ("2", "c", "SUCCESS")}


def test_upload_skips_known_pairs_and_counts_broken_lines(spark):
    lines = fresh_path(spark, "lines")
    good = spark.createDataFrame([pair("1", "a", "2", "b"), pair("3", "c", "4", "d")], PAIR)
    text = good.select(F.to_json(F.struct("*")).alias("value")).unionByName(
        spark.createDataFrame([("{broken",), ('{"asset_id_1":"9"}',)], "value string")
    )
    text.write.text(lines)
    stored = spark.createDataFrame([pair("2", "b", "1", "a")], PAIR)
    split = tables.split_upload(pair_files.read_jsonl(spark, lines), stored)
    assert tables.upload_counts(split).first().asDict() == {"uploaded": 1, "skipped": 1, "errors": 2}
    again = tables.split_upload(pair_files.read_jsonl(spark, lines), stored.unionByName(tables.new_rows(split)))
    assert tables.upload_counts(again).first()["uploaded"] == 0


def test_csv_keeps_nested_json(spark):
    path = fresh_path(spark, "csv")
    rows = spark.sql("select 1 as id, array(named_struct('k', 'a,\"b\"')) as entries")
    exports.to_csv(rows, path)
    back = spark.read.option("header", True).option("escape", '"').csv(path).first()
    assert back["entries"] == '[{"k":"a,\\"b\\""}]'


def test_bundle_folders(spark):
    path = fresh_path(spark, "bundle")
    exports.bundle(spark.createDataFrame([(1, "x"), (2, "y")], "bucket int, v string"), path)
    assert {r["bucket"] for r in spark.read.json(path).collect()} == {1, 2}


def files_frame(spark):
    return spark.createDataFrame(
        [("1", "new", "wav", 20), ("1", "old", "wav", 10), ("1", "m", "mp3", 5)],
        "asset_id string, file_key string, file_format string, created_at int",
    )


@pytest.mark.parametrize(
    "processed, retry, expected",
    [
        ([], False, {"new", "m"}),
        ([("1", "new", 0)], False, {"old", "m"}),
        ([("1", "new", 1)], False, {"old", "m"}),
        ([("1", "new", 1)], True, {"new", "m"}),
        ([("1", "new", 0), ("1", "old", 0), ("1", "m", 0)], True, set()),
    ],
)
def test_older_file_takes_over_once_the_newest_is_done(spark, processed, retry, expected):
    done = spark.createDataFrame(processed, "asset_id string, file_key string, any_error int")
    todo = work.unprocessed(files_frame(spark), done, retry)
    assert {r["file_key"] for r in catalogs.latest_per_format(todo, "file_format").collect()} == expected


def test_any_failed_attempt_marks_the_file(spark):
    rows = [("1", "a", "ERROR"), ("1", "a", "SUCCESS"), ("1", "b", "SUCCESS")]
    state = work.processing_state(spark.createDataFrame(rows, "asset_id string, file_key string, processing_status string"))
    assert {tuple(r) for r in state.collect()} == {("1", "a", 1), ("1", "b", 0)}


def test_unknown_source_is_refused(spark):
    with pytest.raises(ValueError):
        work.backlog("other", {"asset": None, "asset_map": None, "asset_file": None}, None)


def test_id_list_is_trimmed(spark):
    assert [r[0] for r in catalogs.parse_ids(spark, " 12, 7 ,,x").collect()] == ["12", "7", "x"]
    assert catalogs.parse_ids(spark, "").count() == 0


def test_unknown_asset_gives_no_row(spark):
    frame = spark.createDataFrame(
        [("1", "k", "a", "wav", "SUCCESS", "fp")],
        "asset_id string, file_key string, source string, format string, processing_status string, fingerprint string",
    )
    assert fingerprints.lookup_one(frame, "2").count() == 0
    assert fingerprints.lookup_one(frame, "1").first()["file_key"] == "k"


def test_media_listing_takes_the_folder_as_source(spark, tmp_path):
    for name in ("catalog_a/x.mp3", "catalog_b/y.wav", "catalog_b/z.txt"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"12345")
    rows = {tuple(r) for r in files.list_files(spark, str(tmp_path)).collect()}
    assert rows == {("x.mp3", "catalog_a", ".mp3", 5), ("y.wav", "catalog_b", ".wav", 5)}


def test_streamed_pairs_are_stored_once(spark, tmp_path):
    source, out, state = str(tmp_path / "in"), fresh_path(spark, "stream"), fresh_path(spark, "stream-state")
    spark.createDataFrame([pair("1", "a", "2", "b"), pair("3", "c", "4", "d")], PAIR).coalesce(1).write.parquet(source)

    def run():
        stream = spark.readStream.schema(PAIR).option("maxFilesPerTrigger", 1).parquet(source)
        ingest.upload_pairs(stream, out, state)
        return {(r["file_key_1"], r["file_key_2"]) for r in ingest.read_batches(spark, out, PAIR).collect()}

    assert run() == {("a", "b"), ("c", "d")}
    more = [pair("2", "b", "1", "a"), pair("5", "e", "6", "f"), pair("6", "f", "5", "e")]
    spark.createDataFrame(more, PAIR).coalesce(1).write.mode("append").parquet(source)
    stored = run()
    assert len(stored) == 3 and ("a", "b") in stored and ("b", "a") not in stored
    assert run() == stored


def test_pair_records_join_both_endpoints(spark):
    records = spark.createDataFrame(
        [("1", "a", "wav", "s1", 10.0, "x"), ("2", "b", "mp3", "s1", 12.5, "x"), ("3", "c", "wav", "s2", 9.0, "y")],
        "asset_id string, file_key string, format string, source string, duration double, fingerprint string",
    )
    row = ops.assemble(ops.star_links(records), records).first().asDict()
    assert row["duplicate_type"] == "SAME_CONTENT_DIFF_FORMAT" and row["duration_diff"] == 2.5
    assert list(row) == PAIR.names


def test_experiment_counts_pairs_of_any_length(spark, tmp_path):
    """A pair counts by its score alone, whatever the numbers of its order."""
    rows = [(10, 1, 900_000.0, "O", "1-URGENT"), (90_000_000, 2, 440_000.0, "F", "5-LOW"), (30, 3, 1_000.0, "F", "5-LOW")]
    orders = spark.createDataFrame(
        rows, "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string, o_orderpriority string"
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    counted = queries()["experiment_types"](spark, str(tmp_path)).collect()
    assert {r["duplicate_type"]: r["pairs"] for r in counted} == {"SAME_CONTENT_DIFF_FORMAT": 1, "VERY_HIGH_SIMILARITY": 1}


def test_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    """A store of one bucket: its rows go to as many files as their size asks for, and all of them come back."""
    store = ingest.pair_store(f"{tmp_path}/pairs", buckets=1)
    row = ", ".join(f"cast({'id' if f.name.startswith('file_key') else 'null'} as {f.dataType.simpleString()}) {f.name}" for f in PAIR)
    rows = spark.range(40_000).selectExpr(*row.split(", "))
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "64k")
    try:
        store.put(rows, 0)
    finally:
        spark.conf.unset(setting)
    assert len(list(tmp_path.glob("pairs/bucket=0/batch_id=0/*.parquet"))) > 1
    assert store.rows(spark).select("file_key_1").distinct().count() == 40_000
