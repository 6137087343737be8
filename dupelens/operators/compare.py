"""Comparison of two items: content hashes, tags, formats, perturbed versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dupelens.functions.labels import status
from dupelens.functions.sequences import best_alignment

MISSING_TAG = "N/A"


def content_hash(content: Column | str) -> Column:
    """MD5 of the whole content."""
    return F.md5(content)


def normalised_hash(text: Column | str) -> Column:
    """SHA-256 of the text with case and runs of white space made equal."""
    return F.sha2(F.regexp_replace(F.lower(F.trim(text)), r"\s+", " "), 256)


def hash_duplicates(items: DataFrame, hash_col: str) -> DataFrame:
    """Hashes held by more than one item."""
    return items.groupBy(hash_col).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def tag_differences(a: Column | str, b: Column | str) -> Column:
    """Array of (tag, value_1, value_2) over the union of both tag maps, where the values differ."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b

    def value(tags: Column, key: Column) -> Column:
        return F.coalesce(F.try_element_at(tags, key), F.lit(MISSING_TAG))

    both = F.transform(
        F.array_union(F.map_keys(a), F.map_keys(b)),
        lambda k: F.struct(k.alias("tag"), value(a, k).alias("value_1"), value(b, k).alias("value_2")),
    )
    return F.filter(both, lambda d: d["value_1"] != d["value_2"])


def deep_compare(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """Verdict per pair (id_1, id_2): same bytes, same normalised content, tags that differ.

    ``items`` holds id, md5, sha256 and tags, so only hashes are shuffled, never the content.
    """
    left = items.select(*(F.col(c).alias(f"{c}_1") for c in ("id", "md5", "sha256", "tags")))
    right = items.select(*(F.col(c).alias(f"{c}_2") for c in ("id", "md5", "sha256", "tags")))
    joined = pairs.join(left, "id_1").join(right, "id_2")
    same_bytes = F.col("md5_1") == F.col("md5_2")
    same_content = F.col("sha256_1") == F.col("sha256_2")
    differing = F.transform(tag_differences("tags_1", "tags_2"), lambda d: d["tag"])
    return joined.select(
        "id_1",
        "id_2",
        same_bytes.alias("same_bytes"),
        same_content.alias("same_content"),
        F.array_join(F.sort_array(differing), ",").alias("differing_tags"),
        F.when(same_bytes, "IDENTICAL_BYTES").when(same_content, "IDENTICAL_CONTENT").otherwise("DIFFERENT").alias("verdict"),
    )


def format_comparison(files: DataFrame, first: str, second: str) -> DataFrame:
    """Two formats of one asset side by side: sizes, durations, lengths and similarity.

    ``files`` holds asset_id, source, format, file_size, duration and words.
    """
    columns = ("file_size", "duration", "words")

    def side(fmt: str, n: int) -> DataFrame:
        picked = files.where(F.col("format") == fmt)
        return picked.select("asset_id", "source", *(F.col(c).alias(f"{c}_{n}") for c in columns))

    joined = side(first, 1).join(side(second, 2), ["asset_id", "source"])
    scored = joined.withColumn("similarity", best_alignment()("words_1", "words_2"))
    return scored.select(
        "asset_id",
        "source",
        "similarity",
        status(F.col("similarity"), "format").alias("status"),
        F.abs(F.col("duration_1") - F.col("duration_2")).alias("duration_diff"),
        F.try_divide("file_size_1", "file_size_2").alias("size_ratio"),
        F.abs(F.size("words_1") - F.size("words_2")).alias("length_diff"),
    )


def perturbations(words: Column, filler: Column, recased: Column) -> list[tuple[str, Column]]:
    """Named altered versions of a sequence; null where the sequence is too short for one. ``recased`` is the sequence
    of the same text in upper case."""
    n = F.size(words)
    middle = F.floor(n / 2).cast("int") - 5
    repeated = F.flatten(F.transform(words, lambda w, i: F.when(i % 10 == 9, F.array(w, w)).otherwise(F.array(w))))
    return [
        ("exact_copy", words),
        ("trim_start", F.when(n > 10, F.slice(words, 11, F.greatest(n - 10, F.lit(0))))),
        ("trim_end", F.when(n > 20, F.slice(words, 1, F.greatest(n - 10, F.lit(0))))),
        (
            "trim_middle",
            F.when(n > 30, F.filter(words, lambda w, i: (i < middle) | (i >= middle + 10))),
        ),
        ("drop_tokens", F.when(n > 10, F.filter(words, lambda w, i: i % 11 != 10))),
        ("repeat_tokens", repeated),
        ("insert_start", F.concat(F.array_repeat(filler, 5), words)),
        ("change_case", recased),
    ]


def robustness(items: DataFrame, filler: Column) -> DataFrame:
    """Similarity of every altered version with its original, ranked per item (ties in creation order)."""
    named = perturbations(F.col("words"), filler, F.col("recased"))
    changed = items.select("id", "words", *(altered.alias(f"altered_{i}") for i, (_, altered) in enumerate(named)))
    # All versions of an item are scored in one row, so the original goes to Python once; a copy needs no scoring.
    score = best_alignment()
    similar = changed.select("*", *(
        (F.lit(1.0) if name == "exact_copy" else score("words", f"altered_{i}")).alias(f"similarity_{i}")
        for i, (name, _) in enumerate(named)
    ))
    versions = F.filter(
        F.array(
            *(
                F.struct(
                    F.lit(i).alias("created"), F.lit(name).alias("modification"), F.col(f"similarity_{i}").alias("similarity"),
                    (F.size(f"altered_{i}") - F.size("words")).alias("length_change"),
                    F.col(f"altered_{i}").isNotNull().alias("made"),
                )
                for i, (name, _) in enumerate(named)
            )
        ),
        lambda v: v["made"],
    )
    scored = similar.select("id", F.explode(versions).alias("v")).select(
        "id", "v.created", "v.modification", "v.similarity", "v.length_change"
    )
    by_similarity = Window.partitionBy("id").orderBy(F.desc("similarity"), "created")
    return scored.withColumn("rank", F.row_number().over(by_similarity)).drop("created")


def robustness_summary(scored: DataFrame) -> DataFrame:
    """Per altered version: how many, and mean, least and greatest similarity."""
    return scored.groupBy("modification").agg(
        F.count(F.lit(1)).alias("versions"),
        F.round(F.avg("similarity"), 9).alias("mean_similarity"),
        F.min("similarity").alias("least_similarity"),
        F.max("similarity").alias("greatest_similarity"),
    )
