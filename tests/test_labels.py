"""Labels, status texts and summaries on the published experiment scores."""

import pytest
from pyspark.sql import functions as F

from dupelens.functions import labels, names, validation
from dupelens.operators import pairs as ops

# Published scores of 13 altered versions of one file, and of 15 version pairs with their status.
ALTERED = (
    1.0, 0.7510548523206751, 1.0, 0.5369198312236287, 1.0, 0.9957805907172996, 0.9989451476793249, 0.9546413502109705,
    1.0, 0.9989451476793249, 0.03691983122362869, 0.04219409282700422, 0.006329113924050633,
)
VERSIONS = (
    (0.04113924050632911, "❌ DIFFERENT"),
    (0.6656118143459916, "📊 SIMILAR"),
    (0.04113924050632911, "❌ DIFFERENT"),
    (0.6677215189873418, "📊 SIMILAR"),
    (1.0, "🎯 NEARLY IDENTICAL"),
    (0.05590717299578059, "❌ DIFFERENT"),
    (1.0, "🎯 NEARLY IDENTICAL"),
    (0.05590717299578059, "❌ DIFFERENT"),
    (0.04113924050632911, "❌ DIFFERENT"),
    (0.05590717299578059, "❌ DIFFERENT"),
    (1.0, "🎯 NEARLY IDENTICAL"),
    (0.6645569620253164, "📊 SIMILAR"),
    (0.05590717299578059, "❌ DIFFERENT"),
    (0.04113924050632911, "❌ DIFFERENT"),
    (0.6666666666666666, "📊 SIMILAR"),
)


def frame_of(spark, scores):
    return spark.createDataFrame([(float(s),) for s in scores], "similarity double")


def test_published_version_statuses(spark):
    rows = spark.createDataFrame(list(VERSIONS), "similarity double, expected string")
    wrong = rows.where(labels.status(F.col("similarity"), "version") != F.col("expected"))
    assert wrong.count() == 0


def test_published_summary(spark):
    row = ops.summary(frame_of(spark, ALTERED)).first()
    assert row["comparisons"] == 13
    assert round(row["average"], 3) == 0.717
    assert round(row["median"], 3) == 0.996
    assert (row["identical"], row["very_high"], row["high"], row["medium"], row["low"]) == (7, 1, 0, 2, 3)


@pytest.mark.parametrize("scores", [[0.5], [0.1, 0.9], [0.3, 0.3, 0.3, 0.7], [0.2, 0.20001, 0.20002, 0.9], [1.0, 0.0, 1.0]])
def test_median_is_exact(spark, scores):
    ordered = sorted(scores)
    middle = (ordered[(len(ordered) - 1) // 2] + ordered[len(ordered) // 2]) / 2
    assert ops.median(frame_of(spark, scores)).first()[0] == round(middle, 6)


@pytest.mark.parametrize(
    "similarity, same_format, same_source, label",
    [
        (0.95, True, True, "IDENTICAL"),
        (0.95, False, True, "SAME_CONTENT_DIFF_FORMAT"),
        (1.0, True, False, "CROSS_SOURCE_IDENTICAL"),
        (0.80, True, True, "HIGH_SIMILARITY_SAME_SOURCE"),
        (0.9499, True, False, "HIGH_SIMILARITY_CROSS_SOURCE"),
        (0.60, True, True, "RELATED_VERSIONS"),
        (0.5999, True, True, "LOW_SIMILARITY"),
    ],
)
def test_duplicate_type(spark, similarity, same_format, same_source, label):
    column = labels.duplicate_type(F.lit(similarity), F.lit(same_format), F.lit(same_source))
    assert spark.range(1).select(column).first()[0] == label


def test_histogram_bounds(spark):
    hist = ops.histogram(frame_of(spark, [0.0, 0.0999, 0.1, 0.9, 1.0, 1.0, 1.5]))
    counts = {r["bucket_label"]: r["pairs"] for r in hist.collect()}
    assert counts["[0.0-0.1)"] == 2 and counts["[0.1-0.2)"] == 1 and counts["[0.9-1.0)"] == 3
    assert counts["[0.5-0.6)"] == 0 and len(counts) == 10
    shares = {r["bucket_label"]: r["percentage"] for r in hist.collect()}
    assert shares["[0.9-1.0)"] == pytest.approx(300 / 7)  # the pair out of range stays in the total


def test_filters_exclude_each_other():
    with pytest.raises(ValueError):
        ops.attribute_filter(cross_source=True, same_source=True)


def test_sample_takes_all_of_small_buckets(spark):
    rows = [("a", f"f{i}", "b", f"g{i}", 0.95 if i < 3 else 0.25) for i in range(40)]
    pairs = spark.createDataFrame(rows, "asset_id_1 string, file_key_1 string, asset_id_2 string, file_key_2 string, similarity double")
    counts = {r["bucket"]: r["count"] for r in ops.stratified_sample(pairs, 5).groupBy("bucket").count().collect()}
    assert counts == {9: 3, 2: 5}


def test_names(spark):
    rows = spark.createDataFrame(
        [("a/b/song.mp3", "http://x.org/p/file.wav?q=1"), ("song", "http://x.org/p/"), ("x/y.MP3", "no url")], "k string, u string"
    )
    found = [tuple(r) for r in rows.select(names.file_name_from_key("k"), names.file_name_from_url("u", F.col("k"))).collect()]
    assert found == [("song.mp3", "file.wav"), ("song.mp3", "song.bin"), ("y.MP3.mp3", "x/y.MP3.bin")]


def test_json_keys_fall_back_only_where_pairs_are_missing(spark):
    rows = spark.createDataFrame(
        [
            ("1", '[{"file_key":"a","format":"WAV"},{"format":"MP3"}]', '["z"]'),
            ("2", None, '["b","c"]'),
            ("3", "", '["d"]'),
            ("4", "{bad", '["e"]'),
            ("5", None, None),
        ],
        "asset_id string, key_format_pairs string, file_keys string",
    )
    found = {(r["asset_id"], r["file_key"]) for r in names.keys_from_json(rows).collect()}
    assert found == {("1", "a"), ("2", "b"), ("2", "c"), ("3", "d")}


def test_validation_order_and_warnings(spark):
    rows = spark.createDataFrame(
        [
            (100, None, None, None),
            (2048, 0.0, "AQADtMmybfGO8NCN", "audio/mpeg"),
            (2048, 0.5, "AQADtMmybfGO8NCN", "text/html"),
            (20000, 4000.0, "short", "Audio/WAV"),
            (20000, 40.0, None, ""),
        ],
        "size bigint, duration double, fp string, kind string",
    )
    columns = validation.status_columns(F.col("size"), F.col("duration"), F.col("fp"), F.col("kind"))
    found = [(r["error_message"], r["warnings"]) for r in rows.select(*columns).collect()]
    assert found == [
        ("File too small (100 bytes)", []),
        ("Invalid duration", ["suspiciously small"]),
        (None, ["unexpected content type", "suspiciously small", "very short"]),
        ("Fingerprint too short", ["very long"]),
        ("No fingerprint generated", []),
    ]


def test_error_body_is_searched_whole_but_only_when_small(spark):
    rows = spark.createDataFrame([("x" * 900 + " Access DENIED",), ("error " + "x" * 2000,), ("fine",)], "body string")
    assert [r[0] for r in rows.select(validation.is_error_body("body")).collect()] == [True, False, False]
