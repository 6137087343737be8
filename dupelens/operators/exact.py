"""Exact duplicates: groups of equal fingerprints, their members, and the songs that stand in them.

The result is linear for every group size: one row per song with the key of its group, and one row per group member.
The duplicates of a song are the members of its group but itself; they are listed for asked songs only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dupelens.functions.mapping import indicator_of_source
from dupelens.functions.ranking import number_by_count
from dupelens.runtime import materialize

def _encounter() -> Column:
    """Total order of records: (source, asset, file key)."""
    return F.struct("source", "asset_id", "file_key")


def representatives(fingerprints: DataFrame) -> DataFrame:
    """One row per (fingerprint, asset, source): format variants of an asset count once."""
    return fingerprints.groupBy("fingerprint", "asset_id", "source").agg(F.min("file_key").alias("file_key"))


def duplicate_groups(members: DataFrame) -> DataFrame:
    """Fingerprints shared by more than one (asset, source), with the first record seen of each."""
    return (
        members.groupBy("fingerprint")
        .agg(
            F.count(F.lit(1)).alias("copy_count"),
            F.min(_encounter()).alias("first_seen"),
            F.sort_array(F.collect_set("source")).alias("sources"),
        )
        .where("copy_count > 1")
    )


def duplicate_members(fingerprints: DataFrame) -> DataFrame:
    """The duplicate groups in long form: one row per group member, linear in the input.

    The representatives are written first, dealt by fingerprint, asset and source, so a fingerprint that holds a
    large part of all records is spread. They meet the group table, written too, last: both sides of that join are
    plain shuffles with nothing on the same key before or behind it, which adaptive execution can split.
    """
    one_each = materialize(representatives(fingerprints), "representatives")
    groups = materialize(duplicate_groups(one_each), "duplicate-groups")
    return one_each.join(groups, "fingerprint")


def per_song(members: DataFrame) -> DataFrame:
    """One row per (song, indicator) with the key and the size of its first-seen group.

    ``members`` comes from :func:`duplicate_members`; joined on ``group_key`` it gives the duplicates.
    """
    return (
        members.withColumn("product_indicator", indicator_of_source("source"))
        .groupBy(F.col("asset_id").alias("song_id"), "product_indicator")
        .agg(F.min(F.struct("first_seen", _encounter().alias("record"), "fingerprint", "copy_count")).alias("pick"))
        .select(
            "song_id",
            "product_indicator",
            F.lit("music").alias("asset_type"),
            F.col("pick.fingerprint").alias("group_key"),
            F.col("pick.copy_count").alias("copy_count"),
            F.col("pick.record.source").alias("own_source"),
        )
    )


def duplicates_of(songs: DataFrame, members: DataFrame) -> DataFrame:
    """Long rows: each of the asked ``songs`` with each other member of its group."""
    listed = members.select(F.col("fingerprint").alias("group_key"), F.col("asset_id").alias("other_id"), F.col("source").alias("other_source"))
    return (
        songs.select("song_id", "product_indicator", "group_key", "own_source")
        .join(listed, "group_key")
        .where((F.col("other_id") != F.col("song_id")) | (F.col("other_source") != F.col("own_source")))
        .select(
            "song_id",
            "product_indicator",
            F.col("other_id").alias("duplicate_song_id"),
            indicator_of_source("other_source").alias("duplicate_indicator"),
            F.col("other_source").alias("duplicate_source"),
        )
    )


def group_report(members: DataFrame, groups: DataFrame) -> DataFrame:
    """The members of all groups, groups ranked by number of copies, with sources and a fingerprint preview."""
    ranked = number_by_count(groups, "copy_count", "fingerprint", "group_id")
    return members.select("fingerprint", "asset_id", "source").join(ranked, "fingerprint").select(
        "group_id",
        "copy_count",
        "is_cross_source",
        "sources",
        "asset_id",
        "source",
        F.concat(F.substring("fingerprint", 1, 50), F.lit("...")).alias("fingerprint_preview"),
    )


def summary_of(groups: DataFrame) -> DataFrame:
    return groups.select(
        "fingerprint",
        "copy_count",
        (F.size("sources") > 1).alias("is_cross_source"),
        F.array_join("sources", ", ").alias("sources"),
    )


def group_summary(fingerprints: DataFrame) -> DataFrame:
    """One row per group without its members."""
    return summary_of(duplicate_groups(representatives(fingerprints)))


def high_copy(groups: DataFrame, min_copies: int = 10) -> DataFrame:
    return groups.where(F.col("copy_count") >= min_copies)


def cross_source(groups: DataFrame) -> DataFrame:
    return groups.where("is_cross_source")


def groups_of_asset(fingerprints: DataFrame, asset_id: str) -> DataFrame:
    """Groups that hold ``asset_id``, made from the records of its fingerprints only."""
    own = fingerprints.where(F.col("asset_id") == asset_id).select("fingerprint").distinct()
    return group_summary(fingerprints.join(own, "fingerprint", "left_semi"))


def copy_count_distribution(groups: DataFrame) -> DataFrame:
    return groups.groupBy("copy_count").agg(
        F.count(F.lit(1)).alias("groups"), F.count_if("is_cross_source").alias("cross_source_groups")
    )


def _first_members(members: DataFrame, by: list[str], order: list[str], listed: int) -> DataFrame:
    """The first ``listed`` members per key as one array of ``shown``; ranks are limited before the shuffle."""
    return (
        members.withColumn("pos", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        .where(F.col("pos") <= listed)
        .groupBy(*by)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "shown")))["shown"].alias("shown"))
    )


def top_groups(fingerprints: DataFrame, n: int = 5, listed: int = 5) -> DataFrame:
    """The ``n`` groups with most copies, each with its first ``listed`` assets. Only their records are read for these."""
    top = materialize(group_summary(fingerprints).orderBy(F.desc("copy_count"), "fingerprint").limit(n), "top-groups")
    members = representatives(fingerprints.join(F.broadcast(top.select("fingerprint")), "fingerprint", "left_semi"))
    shown = _first_members(members.withColumn("shown", F.col("asset_id")), ["fingerprint"], ["source", "asset_id"], listed)
    more = F.when(F.col("copy_count") > listed, F.lit(", ...")).otherwise("")
    return top.join(shown, "fingerprint").select(
        "fingerprint", "copy_count", "is_cross_source", F.concat(F.array_join("shown", ", "), more).alias("assets")
    )


def preview(songs: DataFrame, members: DataFrame, n: int = 5, listed: int = 3) -> DataFrame:
    """First ``n`` songs, each with at most ``listed`` duplicates and the number left out."""
    first = materialize(songs.orderBy("song_id", "product_indicator").limit(n), "first-songs")
    entry = F.struct(F.col("duplicate_indicator").alias("product_indicator"), F.col("duplicate_song_id").alias("song_id"))
    found = duplicates_of(F.broadcast(first), members).withColumn("shown", entry)
    key = ["song_id", "product_indicator"]
    shown = _first_members(found, key, ["duplicate_source", "duplicate_song_id"], listed)
    left_out = F.col("copy_count") - 1 - listed
    return first.join(shown, key).select(
        *key,
        "asset_type",
        F.concat(
            F.to_json("shown"), F.when(left_out > 0, F.concat(F.lit(" +"), left_out, F.lit(" more"))).otherwise("")
        ).alias("preview"),
    )
