"""Names and keys: file names, version labels, output names, keys held in JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dupelens.schemas import KEY_FORMAT_PAIRS

# Known media suffixes and version tags in their order of priority.
MEDIA_SUFFIXES = (".mp3", ".wav", ".flac", ".m4a")
VERSION_TAGS = (("SV_No_LeadVocals", "SV No LeadVocals"), ("_BOV_", "BOV"), ("_IV_", "IV"))
MASTER_TAG = "Master_v3"
MASTER_LABEL = "Master"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def file_name_from_key(key: Column | str) -> Column:
    """Last path part of the key, with ``.mp3`` added unless it already ends in a media suffix."""
    name = F.element_at(F.split(_column(key), "/"), -1)
    known = name.rlike("(" + "|".join(s.replace(".", "\\.") for s in MEDIA_SUFFIXES) + ")$")
    return F.when(known, name).otherwise(F.concat(name, F.lit(MEDIA_SUFFIXES[0])))


def file_name_from_url(url: Column | str, key: Column) -> Column:
    """Last part of the URL's path, else ``<key>.bin``."""
    name = F.element_at(F.split(F.coalesce(F.try_parse_url(_column(url), F.lit("PATH")), F.lit("")), "/"), -1)
    return F.when(name != "", name).otherwise(F.concat(key.cast("string"), F.lit(".bin")))


def suffix_of(name: Column | str) -> Column:
    """Upper-case suffix with its dot; empty where there is none."""
    return F.upper(F.regexp_extract(_column(name), r"(\.[^./]+)$", 1))


def version_label(name: Column | str) -> Column:
    name = _column(name)
    label = None
    for tag, text in VERSION_TAGS:
        label = (F.when if label is None else label.when)(F.contains(name, F.lit(tag)), text)
    return label.otherwise(MASTER_LABEL)


def version_columns(name: Column | str) -> list[Column]:
    """Version label, format and the flag of every tag."""
    name = _column(name)
    flags = [F.contains(name, F.lit(MASTER_TAG)).alias("master")]
    flags += [
        F.contains(name, F.lit(tag)).alias(flag)
        for (tag, _), flag in zip(VERSION_TAGS, ("sv_no_lead", "bov", "iv"))
    ]
    return [version_label(name).alias("version"), suffix_of(name).alias("format"), *flags]


def output_name(asset_id: Column, source: Column, fmt: Column) -> Column:
    return F.concat(F.lit("asset_"), asset_id, F.lit("_"), source, F.lit("."), F.lower(fmt))


def safe_label(text: Column | str) -> Column:
    """Only letters, digits, ``-`` and ``_`` survive."""
    return F.regexp_replace(_column(text), r"[^\p{L}\p{N}_-]", "")


def keys_from_json(rows: DataFrame) -> DataFrame:
    """File keys of ``key_format_pairs`` (JSON objects) or, where that is missing, of ``file_keys`` (JSON
    texts); rows with broken JSON are left out. Columns: asset_id, pos, file_key."""
    has_pairs = F.coalesce(F.length("key_format_pairs") > 0, F.lit(False))
    from_pairs = F.from_json("key_format_pairs", KEY_FORMAT_PAIRS)["file_key"]
    from_list = F.from_json("file_keys", "array<string>")
    keys = F.when(has_pairs, from_pairs).otherwise(from_list)
    return rows.select("asset_id", F.posexplode(keys).alias("pos", "file_key")).where(F.col("file_key").isNotNull())


def unparsable_json(rows: DataFrame) -> DataFrame:
    """Number of rows whose JSON text is present but broken."""
    has_pairs = F.coalesce(F.length("key_format_pairs") > 0, F.lit(False))
    text = F.when(has_pairs, F.col("key_format_pairs")).otherwise(F.col("file_keys"))
    broken = F.try_parse_json(text).isNull() & text.isNotNull()
    return rows.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(broken).alias("broken_rows"))


def ordered_distinct(rows: DataFrame, key: str, position: str) -> DataFrame:
    """Each key once, with the position of its first occurrence."""
    return rows.groupBy(key).agg(F.min(position).alias("first_position"))
