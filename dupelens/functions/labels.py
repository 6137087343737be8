"""Similarity labels, status texts and pair warnings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and labels.
IDENTICAL, HIGH, RELATED = 0.95, 0.80, 0.60
EXPERIMENT_CUTS = ((0.90, "VERY_HIGH_SIMILARITY"), (0.80, "HIGH_SIMILARITY"), (0.60, "RELATED_VERSIONS"))
EXPERIMENT_IDENTICAL = 0.99
EXPERIMENT_REST = "DIFFERENT_ARRANGEMENTS"
STATUS_TABLES = {
    "format": (
        (0.95, "🎯 NEARLY IDENTICAL - Same audio content in different formats"),
        (0.80, "🔍 VERY SIMILAR - Likely same content with format differences"),
        (0.50, "📊 SIMILAR - Related content but noticeable differences"),
        (0.10, "📈 SOMEWHAT SIMILAR - Some common elements"),
        (None, "❌ DIFFERENT - Completely different audio content"),
    ),
    "version": (
        (0.95, "🎯 NEARLY IDENTICAL"),
        (0.80, "🔍 VERY SIMILAR"),
        (0.50, "📊 SIMILAR"),
        (0.20, "📈 SOMEWHAT SIMILAR"),
        (None, "❌ DIFFERENT"),
    ),
    "copies": (
        (0.99, "🎯 IDENTICAL"),
        (0.80, "🔍 VERY SIMILAR"),
        (0.50, "📊 SIMILAR"),
        (0.10, "📈 SOMEWHAT SIMILAR"),
        (None, "❌ DIFFERENT"),
    ),
}
SIMILARITY_RANGES = ((0.95, "0.95+"), (0.90, "0.90-0.95"), (0.80, "0.80-0.90"), (0.60, "0.60-0.80"), (None, "<0.60"))


def by_cuts(value: Column, table) -> Column:
    """Label of the first cut that ``value`` reaches; the entry without a cut takes the rest."""
    result = None
    for cut, label in table:
        if cut is None:
            return result.otherwise(label)
        result = (F.when if result is None else result.when)(value >= cut, label)
    return result


def duplicate_type(similarity: Column, same_format: Column, same_source: Column) -> Column:
    identical = (
        F.when(same_format & same_source, "IDENTICAL")
        .when(same_source, "SAME_CONTENT_DIFF_FORMAT")
        .otherwise("CROSS_SOURCE_IDENTICAL")
    )
    high = F.when(same_source, "HIGH_SIMILARITY_SAME_SOURCE").otherwise("HIGH_SIMILARITY_CROSS_SOURCE")
    return (
        F.when(similarity >= IDENTICAL, identical)
        .when(similarity >= HIGH, high)
        .when(similarity >= RELATED, "RELATED_VERSIONS")
        .otherwise("LOW_SIMILARITY")
    )


def duplicate_type_of_pair() -> Column:
    """:func:`duplicate_type` over the usual pair columns."""
    return duplicate_type(
        F.col("similarity"), F.col("format_1") == F.col("format_2"), F.col("source_1") == F.col("source_2")
    )


def experiment_type(similarity: Column, same_format: Column) -> Column:
    top = F.when(same_format, "IDENTICAL").otherwise("SAME_CONTENT_DIFF_FORMAT")
    rest = by_cuts(similarity, (*EXPERIMENT_CUTS, (None, EXPERIMENT_REST)))
    return F.when(similarity >= EXPERIMENT_IDENTICAL, top).otherwise(rest)


def status(similarity: Column, table: str) -> Column:
    return by_cuts(similarity, STATUS_TABLES[table])


def similarity_range(similarity: Column) -> Column:
    return by_cuts(similarity, SIMILARITY_RANGES)


def pair_warnings(duration_diff: Column, bitrate_ratio: Column, bit_similarity: Column, score: Column) -> Column:
    """Warnings that apply to a pair, as an array of texts."""
    checks = (
        (duration_diff > 1.0, "duration difference"),
        (bitrate_ratio < 0.5, "low bitrate ratio"),
        (bit_similarity < 0.85, "low bit similarity"),
        (score < 0.9, "low score"),
    )
    return F.filter(F.array(*(F.when(test, text) for test, text in checks)), lambda w: w.isNotNull())
