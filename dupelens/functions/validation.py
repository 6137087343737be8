"""Validation of ingested records, error bodies and error messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits, phrases and message patterns.
MIN_BYTES, SUSPICIOUS_BYTES = 1024, 10240
MIN_FINGERPRINT = 10
SHORT_SECONDS, LONG_SECONDS = 1.0, 3600.0
AUDIO_TYPES = ("audio", "mpeg", "wav", "flac")
ERROR_PHRASES = ("error", "not found", "access denied", "forbidden", "unauthorized", "invalid")
ERROR_CATEGORIES = (
    ("could not be decoded", "decode"),
    ("no such file", "missing"),
    ("permission denied", "permission"),
    ("timeout", "timeout"),
)


def status_columns(size: Column, duration: Column, fingerprint: Column, content_type: Column) -> list[Column]:
    """processing_status, error_message and warnings of a record; the first failing test names the error."""
    message = (
        F.when(size < MIN_BYTES, F.concat(F.lit("File too small ("), size.cast("string"), F.lit(" bytes)")))
        .when(duration.isNull() | (duration <= 0), "Invalid duration")
        .when(fingerprint.isNull(), "No fingerprint generated")
        .when(F.length(fingerprint) < MIN_FINGERPRINT, "Fingerprint too short")
    )
    kind = F.lower(content_type)
    known_type = F.lit(False)
    for name in AUDIO_TYPES:
        known_type = known_type | F.contains(kind, F.lit(name))
    checks = (
        (kind.isNotNull() & (kind != "") & ~known_type, "unexpected content type"),
        ((size >= MIN_BYTES) & (size < SUSPICIOUS_BYTES), "suspiciously small"),
        ((duration > 0) & (duration < SHORT_SECONDS), "very short"),
        (duration > LONG_SECONDS, "very long"),
    )
    warnings = F.filter(F.array(*(F.when(test, text) for test, text in checks)), lambda w: w.isNotNull())
    return [
        F.when(message.isNull(), "SUCCESS").otherwise("ERROR").alias("processing_status"),
        message.alias("error_message"),
        warnings.alias("warnings"),
    ]


def is_error_body(body: Column | str) -> Column:
    """A small body that names an error. Bodies below the size limit are searched whole."""
    body = F.col(body) if isinstance(body, str) else body
    return (F.octet_length(body) < MIN_BYTES) & F.lower(body).rlike("|".join(ERROR_PHRASES))


def error_category(message: Column | str) -> Column:
    text = F.lower(F.col(message) if isinstance(message, str) else message)
    result = None
    for phrase, category in ERROR_CATEGORIES:
        result = (F.when if result is None else result.when)(F.contains(text, F.lit(phrase)), category)
    return result.otherwise("other")
