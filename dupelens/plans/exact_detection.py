"""End-to-end exact detection: two tables, songs and group members, both linear in the input."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dupelens.operators.exact import duplicate_members, per_song
from dupelens.runtime import materialize
from dupelens.sources.fingerprints import usable

SONG = ("song_id", "product_indicator", "asset_type", "group_key", "copy_count")


@dataclass
class ExactResult:
    """``songs``: song_id, product_indicator, asset_type, group_key, copy_count (and own_source);
    ``members``: the members of every group by fingerprint, the group key."""

    songs: DataFrame
    members: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        """The two tables as they are exported."""
        return {
            "songs": self.songs.select(*SONG),
            "members": self.members.select(F.col("fingerprint").alias("group_key"), "asset_id", "source", "file_key"),
        }


def detect(fingerprints: DataFrame) -> ExactResult:
    """Exact duplicates of all usable records; the member table is written once."""
    members = materialize(duplicate_members(usable(fingerprints)), "duplicate-members")
    return ExactResult(per_song(members), members)


def duplicated_assets(fingerprints: DataFrame) -> DataFrame:
    """The song table: each (song, indicator) that has duplicates, with its group."""
    return detect(fingerprints).songs.select(*SONG)
