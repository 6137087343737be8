"""Audit of the duplicated-assets table: one query per check, and their roll-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dupelens.functions.mapping import SOURCE_INDICATOR, indicator_of_source
from dupelens.schemas import DUPLICATE_ENTRY

# What the audit expects.
ASSET_TYPE = "music"
INDICATORS = tuple(SOURCE_INDICATOR.values())


def duplicate_keys(rows: DataFrame, top: int = 10) -> DataFrame:
    """(song, indicator) keys held by more than one row, most frequent first."""
    return (
        rows.groupBy("song_id", "product_indicator")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .where("cnt > 1")
        .orderBy(F.desc("cnt"), "song_id", "product_indicator")
        .limit(top)
    )


def completeness(rows: DataFrame) -> DataFrame:
    """Filled and missing values; a song has duplicates where it has a group."""
    columns = {
        "song_id": "song_id",
        "product": "product_indicator",
        "asset_type": "asset_type",
        "duplicates": "group_key",
    }
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *(F.count(column).alias(f"{name}_count") for name, column in columns.items()),
        *(F.count_if(F.col(column).isNull()).alias(f"null_{name}") for name, column in columns.items()),
    )


def asset_types(rows: DataFrame) -> DataFrame:
    return rows.groupBy("asset_type").agg(F.count(F.lit(1)).alias("cnt"))


def indicator_domain(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("product_indicator")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .withColumn("is_valid", F.col("product_indicator").isin(*INDICATORS))
    )


def array_format(rows_json: DataFrame) -> DataFrame:
    """Valid rows and the ways a JSON ``duplicates`` text can fail, over all rows."""
    entries = F.from_json("duplicates", f"array<{DUPLICATE_ENTRY.simpleString()}>")
    is_list = F.ltrim("duplicates").startswith("[")
    complete = F.forall(
        entries, lambda e: e["product_indicator"].isNotNull() & e["song_id"].isNotNull()
    )
    return rows_json.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(entries.isNull()).alias("unparsable"),
        F.count_if(~is_list).alias("not_a_list"),
        F.count_if(entries.isNotNull() & ~complete).alias("missing_keys"),
    )


def entries_json(members: DataFrame) -> DataFrame:
    """The entry of each group member as a JSON list of one: songs list the entries of their group."""
    entry = F.struct(indicator_of_source("source").alias("product_indicator"), F.col("asset_id").alias("song_id"))
    return members.select(F.to_json(F.array(entry)).alias("duplicates"))


def missing_reciprocals(songs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of groups with edges a -> b without b -> a, where b has a row of its own, and the number of edges.

    A song lists the members of its own group. An edge from a song of group g to a member of g can be one-sided only
    if that member has another own group h, and the song is no member of h. So only memberships outside the own
    group are counted, by (group, own group): ``moved(g, h)`` members of g belong to h, and of the owners of g all
    but ``moved(h, g)`` are missing in h. No pair of songs is made.
    """
    own = songs.select("song_id", "product_indicator", F.col("group_key").alias("own"))
    places = members.select(
        F.col("asset_id").alias("song_id"), indicator_of_source("source").alias("product_indicator"), F.col("fingerprint").alias("group_key")
    )
    moved = (
        places.join(own, ["song_id", "product_indicator"])
        .where("group_key <> own")
        .groupBy("group_key", "own", "song_id", "product_indicator")
        .agg(F.lit(1).alias("one"))
        .groupBy("group_key", "own")
        .agg(F.sum("one").alias("moved"))
    )
    owners = own.groupBy(F.col("own").alias("group_key")).agg(F.count(F.lit(1)).alias("owners"))
    back = moved.select(F.col("own").alias("group_key"), F.col("group_key").alias("own"), F.col("moved").alias("back"))
    missing = F.col("moved") * (F.col("owners") - F.coalesce("back", F.lit(0)))
    return (
        moved.join(owners, "group_key")
        .join(back, ["group_key", "own"], "left")
        .select("group_key", F.col("own").alias("other_group"), missing.alias("missing"))
        .where("missing > 0")
    )


def known_key(rows: DataFrame, song_id: str, indicator: int) -> DataFrame:
    hit = (F.col("song_id") == song_id) & (F.col("product_indicator") == indicator)
    return rows.where(hit).agg(F.count(F.lit(1)).alias("occurrences"))


def multi_indicator(rows: DataFrame) -> DataFrame:
    """Ids that occur under more than one indicator."""
    return (
        rows.groupBy("song_id")
        .agg(F.count_distinct("product_indicator").alias("indicator_count"))
        .where("indicator_count > 1")
    )


def statistics(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("total_songs"),
        F.count_distinct("song_id").alias("unique_song_ids"),
        *(
            F.count_if(F.col("product_indicator") == code).alias(f"{name}_count")
            for name, code in SOURCE_INDICATOR.items()
        ),
    )


def array_size_distribution(rows: DataFrame, top: int = 10) -> DataFrame:
    return (
        rows.groupBy((F.col("copy_count") - 1).cast("int").alias("dup_count"))
        .agg(F.count(F.lit(1)).alias("songs"))
        .orderBy(F.desc("dup_count"))
        .limit(top)
    )


def suite(songs: DataFrame, members: DataFrame, song_id: str, indicator: int) -> DataFrame:
    """One row per check: passed or not, with the number of findings behind the verdict.

    ``known_key`` finds a fault where the asked key occurs more than once; ids under several indicators are counted as
    ``multi_indicator`` and are no fault.
    """
    nulls = completeness(songs).select(
        F.lit("completeness").alias("check_name"),
        (F.col("null_song_id") + F.col("null_product") + F.col("null_asset_type") + F.col("null_duplicates")).alias(
            "findings"
        ),
    )
    formats = array_format(entries_json(members)).select(
        F.lit("array_format").alias("check_name"),
        (F.col("unparsable") + F.col("not_a_list") + F.col("missing_keys")).alias("findings"),
    )

    def counted(name: str, found: DataFrame) -> DataFrame:
        return found.agg(F.count(F.lit(1)).alias("findings")).select(F.lit(name).alias("check_name"), "findings")

    repeated = songs.groupBy("song_id", "product_indicator").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
    one_sided = missing_reciprocals(songs, members).agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("findings"))
    known = known_key(songs, song_id, indicator).select(F.greatest(F.col("occurrences") - 1, F.lit(0)).alias("findings"))
    checks = [
        counted("duplicate_keys", repeated),
        nulls,
        counted("asset_type", asset_types(songs).where(~F.col("asset_type").eqNullSafe(ASSET_TYPE))),
        counted("indicator_domain", indicator_domain(songs).where("not is_valid")),
        formats,
        one_sided.select(F.lit("reciprocity").alias("check_name"), "findings"),
        known.select(F.lit("known_key").alias("check_name"), "findings"),
        counted("multi_indicator", multi_indicator(songs)),
    ]
    results = reduce(DataFrame.unionByName, checks)
    return results.select(
        "check_name", "findings", ((F.col("findings") == 0) | (F.col("check_name") == "multi_indicator")).alias("passed")
    )


def suite_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("passed").alias("passed"),
        F.min("passed").alias("all_passed"),
        F.array_join(F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("check_name")))), ", ").alias("failed"),
    )
