"""Column mappings between catalog codes, formats and sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source name -> product indicator, format id -> format, catalog roles.
SOURCE_INDICATOR = {"catalog_a": 1, "catalog_b": 3}
FORMAT_BY_ID = {1: "wav", 2: "mp3", 3: "aiff"}
AUDIO_ROLES = ("CORE", "MP3")
DEFAULT_FORMAT = "mp3"
DEFAULT_SOURCE = "catalog_a"


def _lookup(key: Column, mapping: dict, default: Column) -> Column:
    result = None
    for code, value in mapping.items():
        result = (F.when if result is None else result.when)(key == code, value)
    return result.otherwise(default)


def format_from_role(role: Column | str) -> Column:
    """``CORE`` files are wav; any other role names its own format."""
    role = F.col(role) if isinstance(role, str) else role
    return F.when(role == "CORE", "wav").otherwise(F.lower(role))


def format_from_id(format_id: Column | str, default: str | None = DEFAULT_FORMAT) -> Column:
    """Format of a numeric id; unknown or missing ids give ``default`` (``None`` = null, to be dropped)."""
    format_id = F.col(format_id) if isinstance(format_id, str) else format_id
    return _lookup(format_id, FORMAT_BY_ID, F.lit(default))


def indicator_of_source(source: Column | str) -> Column:
    """Product indicator of a source name in any case; 0 where unknown."""
    source = F.col(source) if isinstance(source, str) else source
    return _lookup(F.lower(source), SOURCE_INDICATOR, F.lit(0))


def source_of_indicator(indicator: Column | str) -> Column:
    indicator = F.col(indicator) if isinstance(indicator, str) else indicator
    names = {code: name for name, code in SOURCE_INDICATOR.items()}
    return _lookup(indicator, names, F.lit("unknown"))


def normalised_id(raw: Column | str) -> Column:
    """Integer-valued text without leading zeros; null where the text is no integer."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return raw.try_cast("int").cast("string")
