"""Exact groups: first group wins, unknown sources, hot groups, numbering."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from dupelens.functions.ranking import number_by_count
from dupelens.operators import exact, quality
from dupelens.plans.exact_detection import detect

COLUMNS = "asset_id string, file_key string, source string, fingerprint string"


def songs(spark, rows):
    members = exact.duplicate_members(spark.createDataFrame(rows, COLUMNS))
    result = exact.per_song(members)
    found = {(r["song_id"], r["product_indicator"]): [] for r in result.collect()}
    for r in exact.duplicates_of(result, members).orderBy("duplicate_source", "duplicate_song_id").collect():
        found[r["song_id"], r["product_indicator"]].append((r["duplicate_indicator"], r["duplicate_song_id"]))
    return found


def test_format_variants_of_one_asset_are_no_duplicates(spark):
    assert songs(spark, [("1", "1-wav", "catalog_a", "x"), ("1", "1-mp3", "catalog_a", "x")]) == {}


def test_same_id_in_two_sources_is_a_duplicate(spark):
    rows = [("1", "k1", "catalog_a", "x"), ("1", "k2", "Catalog_B", "x"), ("2", "k3", "elsewhere", "x")]
    assert songs(spark, rows) == {
        ("1", 1): [(3, "1"), (0, "2")],
        ("1", 3): [(1, "1"), (0, "2")],
        ("2", 0): [(3, "1"), (1, "1")],
    }


def test_first_seen_group_wins(spark):
    rows = [
        ("A", "A-wav", "catalog_b", "x"),
        ("A", "A-mp3", "catalog_b", "y"),
        ("B", "B-wav", "catalog_b", "x"),
        ("0", "0-wav", "catalog_b", "y"),
    ]
    found = songs(spark, rows)
    assert found[("A", 3)] == [(3, "0")]
    assert found[("B", 3)] == [(3, "A")]
    assert found[("0", 3)] == [(3, "A")]


def test_hot_group_keeps_all_rows(spark):
    rows = [(str(i), f"k{i}", "catalog_a", "hot" if i % 3 == 0 else f"u{i}") for i in range(900)]
    found = songs(spark, rows)
    assert len(found) == 300
    assert all(len(others) == 299 for others in found.values())


def usable(frame):
    return frame.withColumn("processing_status", F.lit("SUCCESS")).withColumn("duration", F.lit(9.0))


def test_a_large_group_is_whole_and_no_row_holds_a_list(spark):
    frame = spark.range(30_050).select(
        F.col("id").cast("string").alias("asset_id"),
        F.concat(F.lit("k"), "id").alias("file_key"),
        F.lit("catalog_a").alias("source"),
        F.when(F.col("id") < 30_000, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("fingerprint"),
    )
    found = detect(usable(frame))
    assert found.members.count() == found.songs.count() == 30_000
    assert found.songs.agg(F.min("copy_count"), F.max("copy_count")).first() == (30_000, 30_000)
    assert not [kind for t in found.tables().values() for _, kind in t.dtypes if kind.startswith("array")]
    assert exact.duplicates_of(found.songs.where("song_id = '7'"), found.members).count() == 29_999
    assert quality.missing_reciprocals(found.songs, found.members).count() == 0


def test_a_hot_fingerprint_is_split(spark):
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        frame = spark.range(0, 300_000, 1, 8).select(
            F.col("id").cast("string").alias("asset_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("file_key"),
            F.lit("catalog_a").alias("source"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") / 6).cast("int").cast("string")).alias("fingerprint"),
        )
        members = exact.duplicate_members(frame)
        members.collect()
        assert "skew=true" in members._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_reciprocity_counts_one_sided_edges_per_pair_of_groups(spark):
    rows = [("A", "A-wav", "catalog_b", "x"), ("A", "A-mp3", "catalog_b", "y"), ("B", "B-wav", "catalog_b", "x"), ("0", "0-wav", "catalog_b", "y")]
    found = detect(usable(spark.createDataFrame(rows, COLUMNS)))
    missing = quality.missing_reciprocals(found.songs, found.members).collect()
    assert [tuple(r) for r in missing] == [("x", "y", 1)]


def test_audit_finds_broken_rows(spark):
    rows = spark.createDataFrame(
        [("[{\"product_indicator\":1,\"song_id\":\"2\"}]",), ("[{\"song_id\":\"2\"}]",), ("{bad",), (None,)], "duplicates string"
    )
    found = quality.array_format(rows).first()
    assert (found["total_rows"], found["missing_keys"], found["unparsable"]) == (4, 1, 2)


def test_numbering_equals_a_global_row_number(spark):
    frame = spark.range(500).select(
        F.concat(F.lit("g"), "id").alias("fingerprint"), (F.when(F.col("id") < 350, 2).otherwise(F.col("id") % 7)).alias("copy_count")
    )
    order = Window.orderBy(F.desc("copy_count"), F.md5("fingerprint"), "fingerprint")
    expected = {r["fingerprint"]: r["n"] for r in frame.withColumn("n", F.row_number().over(order)).collect()}
    found = {r["fingerprint"]: r["group_id"] for r in number_by_count(frame, "copy_count", "fingerprint", "group_id").collect()}
    assert found == expected
